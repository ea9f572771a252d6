"""Structured Streaming: incremental catalog refresh (see ``refresh``)."""
