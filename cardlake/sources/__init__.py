"""Readers, writers and the adapter views over the test tables."""
