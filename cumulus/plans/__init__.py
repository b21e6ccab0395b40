"""Registered queries: each pairs a Spark builder with its DuckDB oracle."""
