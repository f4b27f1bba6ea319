"""Readers, writers and the posting schemas."""
