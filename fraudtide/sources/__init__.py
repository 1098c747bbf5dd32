"""Readers, writers and catalog publication."""
