"""Retail sales analytics as PySpark DataFrame plans: raw order lines in, cleansed
detail, daily metric tables and dashboard answers out."""

__version__ = "0.1.0"
