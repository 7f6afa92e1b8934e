"""verdant: a PySpark-native toolkit for text statistics, page features,
binary classifiers and their evaluation, all expressed on DataFrames."""

__version__ = "0.1.0"
