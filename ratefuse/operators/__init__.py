"""Cleaning, matching, merging, scoring, validation, comparison, analysis."""
