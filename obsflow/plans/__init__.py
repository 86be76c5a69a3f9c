"""Marts and whole jobs, composed of the operators."""
