"""Operators that prepare text and vectors for training runs.

Nothing outside this folder imports it. Each operator takes and returns
DataFrames; ``queries`` registers them over whole tables.
"""
