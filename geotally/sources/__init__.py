"""Readers of landed files, archives, listing pages and tables."""
