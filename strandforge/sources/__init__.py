"""Readers of text formats, and the entries that sources become."""
