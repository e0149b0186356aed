"""Readers and the raw-layer model."""
