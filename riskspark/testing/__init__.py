"""Test support: DuckDB oracle recipes and Spark/DuckDB result comparison."""
