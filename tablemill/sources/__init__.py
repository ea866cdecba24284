"""Registries, readers and fetchers."""
