"""Retail stock and sales analytics as plain Spark DataFrame transformations."""
