"""Incident analytics as reusable DataFrame transformations on Spark."""
