"""Hourly grid-operations analytics on Spark DataFrames."""
