"""Registered queries over the driver tables, their stand-in inputs and DuckDB oracles."""
