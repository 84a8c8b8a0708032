"""Operators over DataFrames: generation, checks, alignment, comparison, run catalogue."""
