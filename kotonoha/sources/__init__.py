"""Readers of text files and content tables, and the token sink."""
