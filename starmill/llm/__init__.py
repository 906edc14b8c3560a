"""Operators for preparing training text at scale, each with a query over the given tables."""
