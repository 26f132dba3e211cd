"""Readers and dimension tables."""
