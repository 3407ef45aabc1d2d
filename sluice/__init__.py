"""Metadata-driven event pipelines on Spark: quality rules, dead letters,
field encryption, scan snapshots, baselines and product recommendations."""
