"""Whole jobs, and the queries by which the operators are checked."""
