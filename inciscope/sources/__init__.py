"""Readers, writers and run logs."""
