"""Whole pipelines: the event logs and the marketing report."""
