"""Medallion analytics for athlete development data on PySpark."""
