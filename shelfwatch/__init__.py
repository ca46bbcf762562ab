"""Retail price history on Spark: ingest, enrichment, type-2 history, upkeep."""
