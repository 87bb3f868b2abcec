"""Pacewright: split-time analytics on PySpark DataFrames."""
