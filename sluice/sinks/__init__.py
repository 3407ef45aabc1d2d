"""Targets: lake tables, upserts, JDBC-shaped rows, dead letters, erasure."""
