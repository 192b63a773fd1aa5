"""Filewright: a PySpark-native engine for regulatory-filing analytics."""

__version__ = "0.1.0"
