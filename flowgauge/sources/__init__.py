"""Readers, writers and the case-event view."""
