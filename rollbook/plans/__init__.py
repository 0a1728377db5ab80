"""Datasets and report tables composed from the operators."""
