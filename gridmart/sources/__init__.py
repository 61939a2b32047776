"""Landed pages and days, seeds, and the staged tables."""
