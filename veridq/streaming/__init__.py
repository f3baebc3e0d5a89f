"""Structured Streaming versions of the stateless operators and keep-first dedupe."""
