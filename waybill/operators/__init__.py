"""Relational operators the metrics are put together from."""
