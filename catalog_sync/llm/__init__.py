"""Operators of a training-data pipeline: dedup, packing, mixing, archives, search, scoring, pages."""
