"""Structured Streaming entry points (file feeds -> incremental tables)."""
