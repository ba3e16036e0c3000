"""Readers, cleaners and event intake."""
