"""Spark-native event detection, clustering and corpus preparation."""
