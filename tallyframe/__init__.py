"""Payments lakehouse analytics expressed as lazy PySpark DataFrame jobs."""
