"""Structured Streaming forms of ingest, upsert and tokenize."""
