"""River observation analytics on Spark."""
