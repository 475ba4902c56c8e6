"""Whole jobs, from table to table."""
