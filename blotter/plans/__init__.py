"""Composed plans: the registered driver-table queries and the pipelines."""
