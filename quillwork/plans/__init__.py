"""Whole jobs, each a composition of operators from DataFrames to DataFrames."""
