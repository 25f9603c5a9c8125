"""Structured Streaming forms of the stateful operators, sinks and whole jobs."""
