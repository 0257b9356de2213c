"""Rebuilding what new or changed sources touch."""
