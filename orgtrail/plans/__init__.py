"""Whole reports: functions of DataFrames and parameters that return a DataFrame."""
