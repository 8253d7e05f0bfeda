"""Scans and listings."""
