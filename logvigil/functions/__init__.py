"""Column expressions without Python UDFs."""
