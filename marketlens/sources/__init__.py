"""Inputs: tables, nested documents and paged services."""
