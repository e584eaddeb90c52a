"""Access-log analytics expressed on DataFrames, Spark ML and Structured Streaming."""
