"""Access-log threat analytics as Spark jobs."""
