"""Clinical data engine expressed as PySpark DataFrame operators and jobs."""
