"""Operators on match tables."""
