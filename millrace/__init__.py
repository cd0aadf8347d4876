"""Spark-native ingestion and warehouse-sync toolkit.

Every operator takes DataFrames and returns DataFrames.  Operators that change
a table return its *new state*; the functions in :mod:`millrace.sinks` commit it.
"""
