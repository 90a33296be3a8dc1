"""Storefront analytics on Spark DataFrames."""
