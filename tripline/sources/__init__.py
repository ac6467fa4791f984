"""Sources: driver tables, drift-tolerant multi-file reads, CSV dimensions,
JSON manifests and hive-partitioned Parquet."""
