"""Operators for training-data pipelines, each a plain function from DataFrames to DataFrames.

Nothing else in the library imports this subpackage.
"""
