"""A Spark-native engine for annotation-quality metadata."""
