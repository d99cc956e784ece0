"""Spark-native corpus engine: documents, pages, citations, duplicates, quality, vectors."""

__version__ = "0.1.0"
