"""Operators for preparing training corpora on Spark, one module each.

Every operator takes DataFrames and returns a DataFrame.  Nothing outside this
subpackage imports it; ``queries.py`` binds the operators to the tables.
"""
