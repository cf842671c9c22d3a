"""Structured Streaming ingest of JSON tweets."""
