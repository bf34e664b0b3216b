"""Attribute extraction from product text as Spark jobs."""
