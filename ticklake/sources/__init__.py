"""Scans, canonical inputs and sinks."""
