"""Lakehouse analytics for multi-country financial data, as Spark jobs."""
