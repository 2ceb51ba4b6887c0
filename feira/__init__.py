"""Retail lakehouse on Spark: clean raw exports, build a star schema, segment customers.

Every transform takes DataFrames and returns a DataFrame; nothing is read or
written except in ``feira.sources`` and ``feira.plans.layers``.
"""
