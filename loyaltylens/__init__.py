"""Retail membership analytics as Spark DataFrame pipelines."""
