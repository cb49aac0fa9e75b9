"""Live score streams: sources, idempotent sink, stateful views."""
