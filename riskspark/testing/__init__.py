"""Oracle SQL (DuckDB) and comparison helpers used by tests and the entry module."""
