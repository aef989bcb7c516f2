"""Spark-native analytics for prediction-market data."""
