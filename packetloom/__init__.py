"""Network-traffic analytics as Spark DataFrame jobs."""
