"""Scans, sinks, schema handling and catalog helpers."""
