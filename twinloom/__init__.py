"""Synthetic tables, loading and reconciliation on Spark."""
