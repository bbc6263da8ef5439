"""Spark-native analytics over parsed device manuals and training-data corpora."""
