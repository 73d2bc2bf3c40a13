"""Subpackage of the link-graph engine."""
