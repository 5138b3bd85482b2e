"""Operators: DataFrames in, DataFrames out. None brings rows to the driver; those that build on ``running`` write a table."""
