"""Metadata-driven energy-data engine on PySpark."""
