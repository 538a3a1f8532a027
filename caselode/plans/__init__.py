"""Wiring of the operators over the test tables."""
