"""Spark-native analytics for document extractions and filing catalogues."""
