"""newsloom: news-stream analytics on PySpark DataFrames and Structured Streaming."""
