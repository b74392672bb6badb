"""Operators on event logs and their parts."""
