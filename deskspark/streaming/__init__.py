"""Structured Streaming versions of the request path and monitoring."""
