"""Whole runs over the layers, and the query catalogue."""
