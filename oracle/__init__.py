"""DuckDB statements that state each query's answer independently of Spark."""
