"""Corpus preparation and run analytics for (source, summary) pairs on Spark."""

__version__ = "0.1.0"
