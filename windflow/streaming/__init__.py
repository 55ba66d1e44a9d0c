"""Structured Streaming: running jobs, idempotent sinks and the stateful operators."""
