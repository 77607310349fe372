"""Scans, manifests and sinks."""
