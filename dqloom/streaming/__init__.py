"""Validation of streams."""
