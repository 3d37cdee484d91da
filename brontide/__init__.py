"""Spark-native engine for versioned forecast data: ingest, models, evaluation, publication."""
