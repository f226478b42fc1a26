"""Writers: partitioned Parquet, tables over files, guarded loads."""
