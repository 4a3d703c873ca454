"""GeoJSON-lines writer."""

from __future__ import annotations

from pyspark.sql import DataFrame

from placemill.operators.features import geojson_features


def write_geojson_lines(places: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One unquoted JSON feature per line."""
    geojson_features(places).write.mode(mode).text(path)
