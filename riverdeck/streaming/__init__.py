"""The batch definitions as Structured Streaming queries."""
