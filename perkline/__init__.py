"""Rule-driven employee benefit analytics on Spark DataFrames and Structured Streaming."""
