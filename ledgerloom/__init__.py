"""Dimensional warehouse jobs for order-management data, on PySpark DataFrames."""
