"""Scans, sinks and stage tables."""
