"""Readers and table helpers."""
