"""Retail star-schema analytics on PySpark DataFrames."""
