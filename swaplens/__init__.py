"""Swap and market analytics as PySpark DataFrame operators."""
