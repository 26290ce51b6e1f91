"""Independent DuckDB formulations of every registered query (the correctness oracle)."""
