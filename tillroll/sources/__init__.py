"""Readers, writers and merges."""
