"""Batch operators over trip tables."""
