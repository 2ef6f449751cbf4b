"""Spark operators for building layered (bronze, silver, gold) lakehouse tables."""
