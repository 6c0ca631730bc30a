"""DataFrame operators: unnesting, joining, grouping and sorting."""
