"""Parquet and CSV writers."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placemill import vocab


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: Sequence[str] = ()) -> None:
    df.write.mode(mode).option("compression", "zstd").partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None, mode: str = "errorifexists") -> None:
    """Header, comma, quotes doubled inside quotes; empty strings stay unquoted like missing values."""
    df = df.select(*columns) if columns else df
    df.write.mode(mode).csv(path, header=True, escape='"', emptyValue="", nullValue="")


def write_register_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The register in its fixed column order."""
    write_csv(df, path, vocab.REGISTER_COLUMNS, mode)


@F.pandas_udf(T.BinaryType())
def _wkb_point(lon: pd.Series, lat: pd.Series) -> pd.Series:
    layout = np.dtype([("order", "u1"), ("kind", "<u4"), ("x", "<f8"), ("y", "<f8")])
    points = np.empty(len(lon), layout)
    points["order"], points["kind"] = 1, 1
    points["x"], points["y"] = lon.to_numpy("f8", na_value=np.nan), lat.to_numpy("f8", na_value=np.nan)
    usable = lon.notna() & lat.notna()
    raw, width = points.tobytes(), layout.itemsize
    return pd.Series([raw[i * width:(i + 1) * width] if ok else None for i, ok in enumerate(usable)], dtype=object)


def wkb_point(lon: Column, lat: Column) -> Column:
    """Little-endian WKB point; NULL when a coordinate is."""
    return _wkb_point(lon, lat)


def with_geometry(master: DataFrame) -> DataFrame:
    return master.withColumn("geom", wkb_point(F.col("lng"), F.col("lat")))


def write_master(master: DataFrame, parquet_path: str, csv_path: str, mode: str = "errorifexists") -> None:
    """Parquet with the WKB point, CSV without it."""
    write_parquet(with_geometry(master), parquet_path, mode)
    write_csv(master, csv_path, mode=mode)
