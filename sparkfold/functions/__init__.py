"""Column functions: scalar and array maths, losses as aggregates."""
