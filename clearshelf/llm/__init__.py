"""Operators of a large-scale training-data pipeline, and the queries that apply them."""
