"""A Spark-native engine for incremental document processing: sources become
chunks and vectors, phase by phase, and tables say what must run again."""
