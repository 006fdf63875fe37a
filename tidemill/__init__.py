"""Spark-native processing of multilingual announcements, their histories and texts."""
