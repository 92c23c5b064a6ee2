"""tagloom: Spark-first operators for tagged-read tables and large text corpora."""

__version__ = "0.1.0"
