"""Operators for preparing training data at scale; queries in ``registry``."""
