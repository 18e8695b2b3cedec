"""Readers, writers, explicit schemas and the entity views over the benchmark tables."""
