"""Operators: functions from DataFrames to DataFrames, and predicates as columns."""
