"""siltbed: Spark-native building blocks for layered analytical tables and panel forecasts."""

__version__ = "0.1.0"
