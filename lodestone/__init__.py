"""Lodestone: user-level analytics operators on Spark DataFrames and streams."""
