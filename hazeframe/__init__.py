"""Spark-native analytics for fleets of hourly environmental sensors."""

__version__ = "0.1.0"
