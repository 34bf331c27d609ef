"""Registered queries over the provided tables, each with an independent SQL oracle."""
