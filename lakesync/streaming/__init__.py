"""Runs triggered by messages."""
