"""Spark-native entity resolution, structured search and data preparation."""
