"""The table build and the query catalogue."""
