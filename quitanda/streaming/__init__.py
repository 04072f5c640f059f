"""Incremental (availableNow) load of landing files into raw tables."""
