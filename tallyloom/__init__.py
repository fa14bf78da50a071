"""Ratings and article analytics as lazy PySpark DataFrame operators."""
