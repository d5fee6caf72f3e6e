"""Whole jobs: one pass over the log, several rollups out of it."""
