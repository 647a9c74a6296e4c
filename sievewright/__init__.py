"""A Spark-native engine for curating corpora of coding problems."""
