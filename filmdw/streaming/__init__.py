"""Incremental loads as file streams."""
