"""Spark-native engine for audited training datasets from assistant sessions."""
