"""Queries over the driver tables and the SQL each one is checked against."""
