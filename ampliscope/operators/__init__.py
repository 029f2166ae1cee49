"""Relational operators from DataFrame to DataFrame."""
