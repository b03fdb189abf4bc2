"""Listing analytics operators on Spark DataFrames."""
