"""Structured Streaming jobs and run helpers."""
