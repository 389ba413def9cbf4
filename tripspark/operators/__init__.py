"""Relational operators over trip-shaped DataFrames."""

from tripspark.operators import aggregates, filters, joins, metrics, topk

__all__ = ["aggregates", "filters", "joins", "metrics", "topk"]
