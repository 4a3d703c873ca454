"""Declared schemas of the inputs, as DDL text."""

from __future__ import annotations

PLACES_RAW = """
    id string,
    names struct<primary: string>,
    categories struct<primary: string, alternate: array<string>>,
    confidence double,
    brand struct<wikidata: string, names: struct<primary: string>>,
    operating_status string,
    addresses array<struct<country: string, region: string, locality: string, freeform: string>>,
    sources array<struct<dataset: string>>,
    bbox struct<xmin: double, ymin: double>
"""
