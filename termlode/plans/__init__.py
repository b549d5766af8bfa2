"""Whole jobs: building an index and searching it."""
