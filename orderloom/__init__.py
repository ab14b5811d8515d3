"""Warehouse loading and order-lifecycle analytics on PySpark DataFrames."""
