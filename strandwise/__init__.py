"""Nascent transcript atlas and interval analytics on Spark DataFrames."""
