"""Punctua: reliability analytics for scheduled transport, on Spark DataFrames."""
