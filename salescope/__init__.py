"""Retail transaction analytics as Spark jobs."""
