"""Operators: DataFrame to DataFrame, without actions of their own unless their docstring says so."""
