"""Cohort-scale variant-call analytics on Spark: DataFrames in, DataFrames out."""
