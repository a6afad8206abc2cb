"""Spatial environment analytics on PySpark."""
