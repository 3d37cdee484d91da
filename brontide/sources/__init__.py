"""Scans, admission checks and sinks."""
