"""Scoring and searching of streams."""
