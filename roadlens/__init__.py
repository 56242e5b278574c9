"""Road-incident analytics on Spark: snapshots, silver tables, marts, severity model, streams."""
