"""jobtide: enrichment and analysis of job postings as plain PySpark DataFrame operators."""
