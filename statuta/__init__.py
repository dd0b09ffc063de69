"""Spark-native engine for legislative documents and the data pipelines around them."""
