"""Scans, table bindings and sinks."""
