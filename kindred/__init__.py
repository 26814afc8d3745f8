"""Kindred: record linkage and data preparation on Spark DataFrames."""
