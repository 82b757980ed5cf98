"""Hospital stock analytics as Spark DataFrame jobs."""
