"""Composed operators Spark lacks as one call: scalable global row numbers,
keyed upserts on parquet, and data-quality checks."""
