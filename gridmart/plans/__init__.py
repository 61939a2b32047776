"""Star schema, reporting queries, map frames and data checks."""
