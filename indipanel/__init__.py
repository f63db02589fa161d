"""Spark-native analytics over long-format indicator panels.

A panel is a table of entity x period x indicator -> value rows. The package
covers the whole path: landed pages, hash-based incremental ingest, versioned
staging, a star schema, gap treatment, wide features with per-period classes,
forest training and scoring, a prediction ledger, data quality and reports.
"""
