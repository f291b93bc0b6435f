"""headway: Spark-native analytics for public-transit feeds."""

__version__ = "0.1.0"
