"""Stacked-panel analytics on PySpark."""
