"""Rollups of a log that is read as a stream."""
