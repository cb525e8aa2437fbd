"""Readers, writers and the adapters of the four sources."""
