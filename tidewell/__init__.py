"""Governed business analytics as PySpark DataFrame plans."""
