"""Operators of the annotation engine."""
