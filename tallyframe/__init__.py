"""Spark-native statistics, preparation, modelling and segmentation for tables and daily panels."""

__version__ = "0.1.0"
