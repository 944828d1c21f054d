"""Exposure analytics on Spark: routing, loading, profiling and named analyses."""

from breakwater.tables import Tables

__all__ = ["Tables"]
