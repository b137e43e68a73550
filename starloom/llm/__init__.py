"""Operators of a training-data pipeline, one module each, and their queries.

Every operator takes and returns DataFrames; ``queries.QUERIES`` binds each to
its whole table, ``queries.SQL`` holds the DuckDB statement where SQL can
express the operator.
"""
