"""Refund-risk analytics and training-data operators on PySpark DataFrames."""
