"""Routing, loading, ledger and catalogue of export files."""
