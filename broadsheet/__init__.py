"""broadsheet: a PySpark-native engine for digitised newspaper pages."""

__version__ = "0.1.0"
