"""Readers, writers and keyed serving tables."""
