"""Retail demand analytics on Spark DataFrames.

Every operator is a lazy function ``DataFrame -> DataFrame`` with explicit
series keys and an explicit order column.  See README.md for the layout.
"""
