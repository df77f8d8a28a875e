"""Retail order lines, read as text, turned into an audited star schema on Spark."""
