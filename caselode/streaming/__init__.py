"""Resumable runs over arriving files."""
