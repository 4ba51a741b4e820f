"""Spark-native analytics for event telemetry and relational tables."""
