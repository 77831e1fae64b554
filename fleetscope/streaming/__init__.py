"""Structured Streaming form of the idempotent telemetry load."""

from fleetscope.streaming.ingest import load_stream, telemetry_stream  # noqa: F401
