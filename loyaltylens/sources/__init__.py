"""Canonical table schemas, readers, writers and the binding to the test tables."""
