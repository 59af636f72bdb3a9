"""Readers, writers and file listing."""
