"""Structured Streaming jobs, state processors and progress metrics."""
