"""Mutational-profile analytics on Spark DataFrames."""
