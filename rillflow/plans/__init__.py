"""Composite operators and the registered queries."""

from . import aggregate_queries, basic_queries, capacity_queries, catalogue_queries, domain_queries, grid_queries, layer_queries, network_queries, shape_queries, source_queries, survey_queries
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "aggregate_queries", "basic_queries", "capacity_queries", "catalogue_queries", "domain_queries", "grid_queries", "layer_queries", "network_queries", "shape_queries", "source_queries", "survey_queries"]
