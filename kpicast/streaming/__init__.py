"""Incremental forms of the batch rollups."""
