"""Bid logs derived from the driver's tables, with the matching SQL."""
