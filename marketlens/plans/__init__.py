"""Queries over the given tables, with equivalent SQL."""
