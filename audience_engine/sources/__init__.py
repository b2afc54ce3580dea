"""Readers, payload flattening and writers."""
