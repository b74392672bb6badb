"""Incremental loading of report and event files."""
