"""silsila: a Spark-native engine that turns semi-structured corpora into a queryable knowledge base."""
__version__ = "0.1.0"
