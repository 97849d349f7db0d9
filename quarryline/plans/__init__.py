"""Multi-step jobs and the query catalogue."""
