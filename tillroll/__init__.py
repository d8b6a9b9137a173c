"""Basket analytics on Spark DataFrames.

The input everywhere is a *scan log*: one row per scanned line of a shopping
visit, with the columns of :data:`tillroll.sources.scanlog.SCAN_COLUMNS`.
"""
