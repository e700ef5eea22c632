"""Incremental pickup of monthly files."""
