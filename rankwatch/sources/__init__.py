"""Readers, writers, staging and table bindings."""
