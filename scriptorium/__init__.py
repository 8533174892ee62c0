"""PySpark-native analytics over page-structured document editions."""

__version__ = "0.1.0"
