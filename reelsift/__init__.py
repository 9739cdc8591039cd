"""Catalog curation on Spark DataFrames."""
