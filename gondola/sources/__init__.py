"""Delimited source files and the Parquet lake."""
