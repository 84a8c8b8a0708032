"""Declarative descriptions of tables, loads and runs."""
