"""Readers, writers and maintenance jobs."""
