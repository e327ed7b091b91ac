"""Landing documents, CSV files, versioned Parquet snapshots, JDBC and table definitions."""
