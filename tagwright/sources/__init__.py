"""Readers of posts, tags and payloads, and writers of tagged posts."""
