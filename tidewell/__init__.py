"""Tidewell: change-data-capture, lakehouse ingestion and training-data operators on PySpark."""
