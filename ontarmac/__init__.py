"""Flight-delay analytics as Spark DataFrame jobs."""
