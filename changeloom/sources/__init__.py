"""Readers of change logs."""
