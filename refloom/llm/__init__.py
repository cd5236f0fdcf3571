"""Operators of a training-data pipeline, each a function over DataFrames.

Nothing else in the library imports this subpackage. ``queries`` holds the registered
queries and their SQL; the operators know nothing of them.
"""
