"""Retail price analytics on Spark: typed ingestion, star schema, price metrics,
data quality, profiling and dashboard aggregates, all as DataFrame functions."""
