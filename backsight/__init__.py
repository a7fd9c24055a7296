"""Decision analytics on logged data, written as Spark DataFrame jobs."""
