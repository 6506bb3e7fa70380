"""Snapshot tables, their catalog, and query sources."""
