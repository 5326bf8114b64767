"""Change-feed analytics on PySpark DataFrames and Structured Streaming."""
