"""Structured Streaming: scoring with model refresh, and keyed tables fed by streams."""
