"""Continuous ingest and live counts with Structured Streaming."""
