"""Catalog ETL and incremental sync as PySpark DataFrame transformations."""
