"""Operators: functions from DataFrames (and a run date) to DataFrames."""
