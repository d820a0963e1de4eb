"""Feeds and staging views."""
