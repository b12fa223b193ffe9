"""quirework: a Spark-native engine for page documents (detections, regions, lines, pages)."""

__version__ = "0.1.0"
