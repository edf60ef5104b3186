"""Spark-native analytics for hourly and monthly power-grid data."""
