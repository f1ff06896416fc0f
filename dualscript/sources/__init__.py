"""Readers, writers and materialisation."""
