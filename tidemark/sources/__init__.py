"""Readers and writers, and mappers from source payloads to the posting schema."""
