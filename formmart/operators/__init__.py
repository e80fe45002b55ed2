"""Relational operators of the feature mart (all DataFrame → DataFrame)."""
