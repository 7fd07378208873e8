"""Manufacturing-quality analytics as Spark DataFrame jobs."""
