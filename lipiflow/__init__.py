"""A Spark-native engine for turning collections of documents into clean, queryable tables."""
