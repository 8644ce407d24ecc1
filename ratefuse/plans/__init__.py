"""Whole jobs: the configured run, and the catalogue of registered queries."""
