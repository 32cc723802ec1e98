"""Spark-native analytics over software-delivery activity."""
