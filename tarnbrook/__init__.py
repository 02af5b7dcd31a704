"""Incremental warehouse loading on Spark: tolerant CSV loads, change capture,
merges, star schemas, time travel and row policies, all as DataFrame plans."""
