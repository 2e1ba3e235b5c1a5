"""Scans, source metadata and sinks."""
