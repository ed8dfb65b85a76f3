"""Satellite emission analytics as PySpark DataFrame plans."""
