"""logspark: security-log normalisation and enrichment as Spark DataFrame jobs."""
