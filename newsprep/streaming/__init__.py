"""Monitoring of a prediction log with Structured Streaming."""
