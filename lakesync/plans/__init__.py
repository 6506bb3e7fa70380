"""Sync jobs: configuration, order, retries and runs."""
