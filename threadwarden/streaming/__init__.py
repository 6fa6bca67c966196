"""Incremental forms of the assessment jobs."""
