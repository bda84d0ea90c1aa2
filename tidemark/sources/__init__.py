"""Sources: series panels derived from tables, dataset manifests, and the
manifest-listed Parquet scan of stored observations."""
