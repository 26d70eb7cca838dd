"""A Spark-native engine for analysing and cross-linking large collections of structured text."""
