"""Incremental staging."""
