"""Dataflows over markets: each operator is a function of DataFrames without actions inside."""
