"""Readers, writers, catalog tables and the chunk store."""
