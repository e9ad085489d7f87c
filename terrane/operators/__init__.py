"""Operators: functions from DataFrames to lazy DataFrames."""
