"""Paid-search and marketing event-log analytics on Spark DataFrames."""
