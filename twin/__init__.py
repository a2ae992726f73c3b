"""DuckDB twin of every registered query (the correctness oracle)."""
