"""Operators for training-data pipelines; `queries` registers them over the Parquet tables."""
