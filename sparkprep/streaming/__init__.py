"""Incremental and resumable processing."""
