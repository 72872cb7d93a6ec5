"""Whole jobs: read, prepare, write."""
