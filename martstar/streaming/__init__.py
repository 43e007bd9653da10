"""Structured Streaming entry points over the landing directory."""
