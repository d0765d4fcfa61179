"""Incremental counting with Structured Streaming."""
