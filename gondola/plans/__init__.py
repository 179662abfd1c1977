"""Whole jobs over a lake, and the registered queries over the star-schema test tables."""
