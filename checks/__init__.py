"""Checks of the registered queries against independent SQL."""
