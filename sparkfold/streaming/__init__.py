"""Scoring and monitoring of unbounded tables."""
