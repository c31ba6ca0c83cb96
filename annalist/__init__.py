"""Spark-native longitudinal data preparation."""
