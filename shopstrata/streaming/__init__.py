"""Structured Streaming sinks, state and jobs."""
