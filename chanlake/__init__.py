"""Spark-native analytics for scraped message channels.

Subpackages: ``functions`` (Column expressions), ``operators`` (DataFrame
operators), ``sources`` (readers/writers/stores), ``plans`` (jobs, models and
the registered queries), ``streaming`` (Structured Streaming jobs).
"""

__version__ = "0.1.0"
