"""Incremental arrival of price files."""
