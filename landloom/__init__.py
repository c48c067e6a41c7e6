"""Spark-native engine for parcel and owner data."""

__version__ = "0.1.0"
