"""Waybill: a logistics warehouse on Spark.

Change logs become keyed dimension tables, business events and daily metrics.
Every operator is a plain ``DataFrame -> DataFrame`` function.
"""
