"""Operators over DataFrames; each is a function from frames and column names to a frame."""
