"""Incremental append of newly arrived export files."""
