"""Readers, writers and the schemas they declare."""
