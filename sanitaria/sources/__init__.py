"""Scans: the store, landing files, dimensions and file listings."""
