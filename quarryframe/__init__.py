"""Spark-native analytics for frame-indexed, mask-centred and manifest-driven datasets."""

__version__ = "0.1.0"
