"""Spark-native analytics over dirty customer transactions."""
