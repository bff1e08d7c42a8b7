"""Crawler-traffic analytics over web access logs, as plain Spark DataFrames."""
