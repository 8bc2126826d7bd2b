"""Readers, writers and table replication."""
