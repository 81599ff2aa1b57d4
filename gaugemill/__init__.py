"""Sensor readings on Spark: ingest, clean, report and keep summaries up to date."""
