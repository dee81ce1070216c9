"""Delivery-performance analytics on Spark DataFrames."""
