"""Relational operators of the load: land, validate, stage, publish, profile, metrics."""
