"""Spark-native engine for document, knowledge-graph and vector data."""

__version__ = "0.1.0"
