"""Whole plans and the query registry."""
