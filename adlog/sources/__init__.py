"""Report files, event exports and store tables as clean DataFrames, and the report sink."""
