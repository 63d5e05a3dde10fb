"""Nested customer documents from flat files."""
