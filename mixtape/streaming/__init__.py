"""Micro-batch recommendation of arriving basket requests (Structured Streaming)."""
