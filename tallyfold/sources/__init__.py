"""Readers. Each takes an explicit schema or connection options and returns a DataFrame."""
