"""Customer-integration warehouse as Spark DataFrame jobs."""
