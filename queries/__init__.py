"""Queries that run the operators over the given tables, each with its SQL twin."""
