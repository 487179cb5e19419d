"""Fixture views, the star schema, and the registered queries with their DuckDB oracles."""
