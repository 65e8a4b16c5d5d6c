"""Maritime, trade and energy analytics as Spark DataFrame jobs."""
