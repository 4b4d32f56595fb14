"""Vessel speed analytics as Spark DataFrame transformations."""
