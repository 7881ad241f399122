"""runlens: Spark-native analytics over large collections of repeated model runs."""

__version__ = "0.1.0"
