"""Checks of the library against DuckDB: raw inputs, queries and oracle SQL."""
