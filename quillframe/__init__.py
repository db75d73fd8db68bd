"""A PySpark-native analytics engine for historical-record text."""
