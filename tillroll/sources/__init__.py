"""Readers, writers, table contracts and the star-schema adapter."""
