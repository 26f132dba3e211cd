"""Stages from DataFrame to DataFrame."""
