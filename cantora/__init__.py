"""cantora: a Spark-native engine for time-stamped transcripts and text corpora."""
