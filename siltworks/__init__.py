"""Contract-driven ingestion, typing and quality checks on PySpark DataFrames."""
