"""Retail markdown (end-of-life price cut) analytics as Spark DataFrame operators."""
