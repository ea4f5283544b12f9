"""newsloom: a PySpark engine for trend detection, deduplication and ranking of feed items."""

__version__ = "0.1.0"
