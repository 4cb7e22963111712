"""Card-event analytics as Spark DataFrame jobs and Structured Streaming queries."""
