"""Catalogue cleaning and text analytics as PySpark DataFrame operators."""
