"""Readings, rules and keyed tables as DataFrames."""
