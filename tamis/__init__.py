"""Spark-native curation of question banks and similar short texts."""
