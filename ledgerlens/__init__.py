"""Analyses and data pipelines on PySpark."""
