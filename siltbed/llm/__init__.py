"""Training-data operators: functions from DataFrames to DataFrames.

Nothing outside this subpackage imports it.
"""
