"""The marts: functions from input DataFrames and a run date to a DataFrame."""
