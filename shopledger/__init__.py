"""Commerce analytics as Spark DataFrame jobs."""
