"""A PySpark-native engine for curated record catalogues."""
