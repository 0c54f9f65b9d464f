"""Spark-native trip lakehouse: land, clean, enrich, audit and model trip records."""
