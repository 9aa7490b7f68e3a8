"""Pipelines made of operators, and the queries over the test tables."""
