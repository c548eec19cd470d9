"""Spark-native operators for road-segment analytics: batch, streaming and serving lookups."""
