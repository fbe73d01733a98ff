"""Queries composed of operators."""
