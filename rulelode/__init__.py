"""Review-knowledge analytics on Spark."""
