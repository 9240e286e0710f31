"""Checks, encoders, splits, estimators, scoring and metrics."""
