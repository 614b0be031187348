"""Relational operators of the match-analytics model."""
