"""Structured Streaming flows, stateful scoring and the outbox sink."""
