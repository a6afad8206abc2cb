"""Pose streams and what vehicles feel."""
