"""Order analytics on Spark: nested order documents to tables, checks, measures and snapshots."""
