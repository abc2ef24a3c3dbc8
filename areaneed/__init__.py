"""Area and business need scoring as Spark DataFrame jobs."""
