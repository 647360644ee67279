"""Lake tables for sports statistics, built on Spark DataFrames and Structured Streaming."""
