"""Spark-native analytics over location-aware public announcements."""
