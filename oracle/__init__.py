"""Independent SQL for every registered query, for a DuckDB side-by-side check."""
