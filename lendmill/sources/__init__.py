"""Readers, writers, declared schemas and the domain views over the driver tables."""
