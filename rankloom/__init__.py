"""Retrieval-dataset analytics on Spark DataFrames."""
