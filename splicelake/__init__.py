"""Interval analytics for transcript annotations, planned by Spark."""

__version__ = "0.1.0"
