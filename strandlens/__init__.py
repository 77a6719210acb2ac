"""Strandlens: a PySpark-native engine for barcoded short-read sequencing data."""

__version__ = "0.2.0"
