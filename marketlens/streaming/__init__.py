"""Continuous forms of the dataflows."""
