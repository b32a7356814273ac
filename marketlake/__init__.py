"""marketlake: market-research data products as PySpark jobs."""
