"""Structured Streaming: sources, event-time windows, stateful alerts and sinks."""
