"""Readers (A1-A11) and writers."""
