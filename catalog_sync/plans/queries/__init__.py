"""Queries over the driver tables, grouped by what they exercise."""
