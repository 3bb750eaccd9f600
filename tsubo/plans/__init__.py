"""Whole pipelines built from the operators, and the query registry."""
