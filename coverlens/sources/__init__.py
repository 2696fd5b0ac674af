"""Readers, writers and the reference dimensions."""
