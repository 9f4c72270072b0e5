"""Operator compositions: stage tables, registered queries and their SQL oracles."""
