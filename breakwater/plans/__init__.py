"""Guarded SQL, the driver-table views and the query registry."""
