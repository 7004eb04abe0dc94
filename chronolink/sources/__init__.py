"""Readers for XML page dumps."""
