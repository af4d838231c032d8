"""Analytics for a saved music library, written as Spark DataFrame jobs."""
