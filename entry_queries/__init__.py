"""The registered queries and their DuckDB equivalents, by group."""
