"""Usage-forecast analytics as PySpark DataFrame jobs."""
