"""Scans of landed files and of managed tables, and the sinks that write them."""
