"""Operators over index tables: each is a function of DataFrames giving a DataFrame."""
