"""Chains of operators from gathered tables to review tables."""
