"""Spark rollups over a partitioned ad-bidding log."""
