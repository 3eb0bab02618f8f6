"""A PySpark-native analytics engine for exchange tick data."""
