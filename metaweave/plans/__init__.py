"""End-to-end pipelines, the registered queries and their DuckDB oracle."""
