"""Operators over environment tables."""
