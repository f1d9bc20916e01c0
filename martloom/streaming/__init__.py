"""Incremental loads driven by a file stream."""
