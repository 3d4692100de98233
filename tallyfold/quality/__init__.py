"""Declarative data-quality rules: evaluated in one pass, reported as tables."""
