"""The queries that are checked and timed, over the given test tables."""
