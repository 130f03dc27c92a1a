"""Readers, constants and writers."""
