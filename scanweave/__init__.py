"""Spark operators that turn dated network scans into a temporal property graph."""
