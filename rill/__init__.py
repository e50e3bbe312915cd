"""Access-log and metric stream jobs on Spark: batch and Structured Streaming from one set of DataFrame operators."""
