"""Incremental intake of register files."""
