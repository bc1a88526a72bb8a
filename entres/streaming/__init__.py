"""Arriving candidates against a standing reference side."""
