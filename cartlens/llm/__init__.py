"""Operators for preparing large text corpora (training data) on Spark.

Nothing outside this package imports it.  Every operator is a function from
DataFrames to DataFrames with a general interface; the thin ``opN_*`` queries
in ``queries.py`` derive their fixed result columns from them.
"""
