"""Readers and writers of environment files."""
