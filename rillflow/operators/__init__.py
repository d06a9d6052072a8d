"""Relational kernels: DataFrame in, DataFrame out."""
