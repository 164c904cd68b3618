"""Structured Streaming feeds and their foreachBatch handlers."""
