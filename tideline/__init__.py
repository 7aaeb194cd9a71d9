"""Tideline: change-data operators for PySpark.

Every operator takes DataFrames and returns a DataFrame; the modules under
``streaming`` only add source, sink and checkpoint around the same operators.
"""
