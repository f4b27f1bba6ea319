"""Transformations: DataFrame in, DataFrame out, nothing collected."""
