"""Structured Streaming ingest of topic feeds (S1 + P1-P7 + F1/F2 + W1)."""
