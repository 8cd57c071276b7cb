"""Structured Streaming sources, sinks and de-duplication."""
