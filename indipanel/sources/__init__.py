"""Landed page files and stored tables."""
