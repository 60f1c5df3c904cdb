"""Structured Streaming ingestion of activity events."""
