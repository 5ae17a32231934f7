"""Readers, sinks, schemas and probers."""
