"""Structured Streaming over stage logs."""
