"""Spark-native telemetry quality analytics."""
