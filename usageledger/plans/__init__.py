"""Reports: incremental loads, full snapshots, scoped views and their publication."""
