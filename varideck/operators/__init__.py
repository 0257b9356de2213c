"""Operators over variants, calls, reads, coverage and gVCF blocks."""
