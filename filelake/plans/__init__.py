"""Registered queries over the given tables, with their check SQL."""
