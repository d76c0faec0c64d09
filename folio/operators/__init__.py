"""Transformations of DataFrames."""
