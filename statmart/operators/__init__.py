"""Relational operators: each takes DataFrames and column names, returns a lazy DataFrame."""
