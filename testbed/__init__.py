"""The engine's source tables, derived from the test tables: as DataFrames and as SQL."""
