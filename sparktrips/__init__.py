"""Spark-native trip analytics: cleaning, profiling, features, models, validation, logs."""
__version__ = "0.1.0"
