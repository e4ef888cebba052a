"""sievework: Spark-native curation of image and document collections."""
