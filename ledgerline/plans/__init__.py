"""Jobs that put the stages together, and the query catalogue."""
