"""Structured Streaming: metric queries on event streams and their runners."""
