"""A PySpark-native engine that audits and rebuilds documents extracted from pages."""
