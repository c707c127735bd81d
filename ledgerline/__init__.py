"""Ledgerline: tax-register analytics as PySpark DataFrame, SQL and Structured Streaming transforms."""
