"""Marts: compositions of operators that reproduce the domain tables."""
