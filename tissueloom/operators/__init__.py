"""Spatial, expression and lineage operators; every function takes and returns DataFrames."""
