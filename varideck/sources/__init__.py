"""Readers, writers, the file inventory, and the projections of the test tables."""
