"""PySpark-native claims analytics: typed staging, star schema, condition marts."""
