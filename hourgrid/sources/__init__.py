"""Readers of archives, curve files, lookups, networks and scenario messages."""
