"""Operators of the data-quality engine over DataFrames."""
