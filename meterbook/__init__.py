"""Utility-billing analytics and data maintenance as PySpark DataFrame jobs."""
