"""Readers, writers and bindings onto stored tables."""
