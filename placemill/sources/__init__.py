"""Readers: places, tagged TSV, polygon layers, license registers."""
