"""Registered queries (``catalog``) and their independent DuckDB oracles (``oracle``)."""
