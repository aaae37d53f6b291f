"""Manifest ingest and resume with Structured Streaming."""
