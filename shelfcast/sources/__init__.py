"""Readers, writers and the projection of the driver tables into Bronze shape."""
