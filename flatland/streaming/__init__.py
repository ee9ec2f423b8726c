"""Incremental landing of arriving files with Structured Streaming."""
