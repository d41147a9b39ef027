"""Spark-native analytics for timed text, media catalogues and request logs."""
