"""Linkage operators over DataFrames."""
