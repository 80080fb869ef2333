"""Whole jobs: raw files to the clean table, and the clean table to the six aggregate tables."""
