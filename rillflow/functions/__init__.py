"""Column functions: formulas, curves, fuzzy systems, classifications, geometry."""
