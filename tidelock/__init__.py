"""Spark-native change capture, entity resolution and reconciliation."""
