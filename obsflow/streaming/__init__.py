"""Structured Streaming forms of the operators, sinks and replay."""
