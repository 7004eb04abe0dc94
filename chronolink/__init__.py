"""Time-ranged link graphs from revisioned documents, as Spark DataFrame jobs."""
