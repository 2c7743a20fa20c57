"""Readers, writers, declared schemas and generators."""
