"""Streaming transaction-risk analytics on Spark DataFrames.

Every transform is ``DataFrame -> DataFrame`` and works on a batch or a stream;
see README.md for the map from operator to function.
"""
