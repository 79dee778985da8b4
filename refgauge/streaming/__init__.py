"""Dump files taken in as they arrive."""
