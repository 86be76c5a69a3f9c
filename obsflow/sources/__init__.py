"""Scans and generated relations."""
