"""Curation of traces as they arrive."""
