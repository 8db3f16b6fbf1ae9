"""Reusable DataFrame operators: (DataFrame, column names) -> DataFrame."""
