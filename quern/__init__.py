"""Spark-native curation of keyed, text-derived records."""
