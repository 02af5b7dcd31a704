"""Operators and queries for preparing training text."""
