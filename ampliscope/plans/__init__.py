"""Queries over the test tables, and end-to-end plans."""
