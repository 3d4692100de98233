"""Structured Streaming queries over the same operators as the batch jobs."""
