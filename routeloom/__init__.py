"""Routeloom: regional logistics-network analytics on PySpark DataFrames."""
