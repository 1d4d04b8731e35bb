"""Spark-native behavioural event analytics: sessions, windowed metrics, routing and metric queries."""

__version__ = "0.1.0"
