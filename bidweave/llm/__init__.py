"""Operators of a training-data pipeline over text, vectors and urls."""
