"""Register files by the columns they have: equal and near signatures, and the mapping a new file could use.

Only the head of a text file is decoded (``HEAD_BYTES``, cut off before Python sees it); a workbook is opened as a whole. The header is
the first of the first ``HEAD_ROWS`` rows with as many filled cells as any of them.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemill.sources.registers import decode_text
from placemill.sources.registry import CSV_FORMATS, SourceSpec, registry_frame
from placemill.sources.xlsx import sheet_rows

HEAD_BYTES = 1 << 16
HEAD_ROWS = 10


def _head_text(content: bytes, encoding: str | None) -> str:
    """The head as text; bytes of a character that the cut has parted are left off."""
    for cut in range(4):
        try:
            return decode_text(content[:len(content) - cut], encoding)
        except ValueError:
            if len(content) < HEAD_BYTES:
                raise
    raise ValueError("text in no known encoding: declare one in the registry")


def titles_of(content: bytes, format: str, encoding: str | None = None, sheet: str = "#0") -> list[str]:
    """The column titles of a file's head, stripped, without blank ones."""
    if format in CSV_FORMATS:
        rows = csv.reader(_head_text(content, encoding).splitlines(keepends=True))
    else:
        rows = sheet_rows(content, int(sheet[1:]) if sheet.startswith("#") else sheet)
    heads = [[str(c).strip().strip("﻿").strip() for c in row] for row in islice(rows, HEAD_ROWS)]
    filled = lambda row: sum(map(bool, row))
    return [c for c in max(heads, key=filled, default=[]) if c]


def file_signatures(files: DataFrame) -> DataFrame:
    """(file, titles, signature) of files (file, format, encoding, sheet, content): the sorted distinct titles, and their hash."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [titles_of(f["content"], f["format"], f["encoding"], f["sheet"] or "#0") for f in batch.to_pylist()]
            yield pa.record_batch([batch.column("file"), pa.array(found, pa.list_(pa.string()))], names=["file", "titles"])

    head = F.when(F.col("format").isin(*CSV_FORMATS), F.substring("content", 1, HEAD_BYTES)).otherwise(F.col("content"))
    read = files.select("file", "format", "encoding", "sheet", head.alias("content")).mapInArrow(each, "file string, titles array<string>")
    titles = F.array_sort(F.array_distinct("titles"))
    return read.select("file", titles.alias("titles"), F.sha2(F.array_join(titles, "\n"), 256).alias("signature"))


def signature_clusters(signed: DataFrame) -> DataFrame:
    """(signature, titles, n_files, first_file)."""
    return signed.groupBy("signature").agg(F.first("titles").alias("titles"), F.count(F.lit(1)).alias("n_files"), F.min("file").alias("first_file"))


def _jaccard(a: str, b: str):
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def _rare_titles(sets: DataFrame, counts: DataFrame, least: float) -> DataFrame:
    """Each set's rarest titles, of which two sets at least ``least`` alike must share one."""
    ranked = sets.select("*", F.explode("titles").alias("title")).join(counts, "title")
    order = F.array_sort(F.collect_list(F.struct("n", "title")))
    kept = ranked.groupBy(*sets.columns).agg(order.alias("_order"))  # as many rows as a file has columns
    needed = F.size("titles") - F.ceil(F.size("titles") * F.lit(least) - 1e-9).cast("int") + 1
    return kept.withColumn("title", F.explode(F.slice("_order", F.lit(1), needed))).withColumn("title", F.col("title.title")).drop("_order")


def near_signatures(signed: DataFrame, least: float = 0.6) -> DataFrame:
    """(signature, other, jaccard) of different signatures whose title sets are at least ``least`` alike, signature < other.

    Signatures meet in an inverted index of their rarest titles only, so that a title which every file has joins nothing.
    """
    sets = signed.select("signature", "titles").distinct().where(F.size("titles") > 0)
    counts = sets.select(F.explode("titles").alias("title")).groupBy("title").agg(F.count(F.lit(1)).alias("n"))
    index = _rare_titles(sets, counts, least)
    other = index.select(F.col("signature").alias("other"), F.col("titles").alias("other_titles"), "title")
    met = index.join(other, "title").where(F.col("signature") < F.col("other"))
    alike = met.select("signature", "other", _jaccard("titles", "other_titles").alias("jaccard")).where(F.col("jaccard") >= least - 1e-9)
    return alike.distinct()


def propose_mappings(signed: DataFrame, specs: Sequence[SourceSpec]) -> DataFrame:
    """(file, source_id, n_found, n_wanted): for each file the registry entry whose mapped columns it has most of (by share, then by
    number, then by order of the registry); no row if it has none of any entry's columns.

    An equi-join on titles with the caller's own list of entries.
    """
    wanted = registry_frame(signed.sparkSession, specs).select(
        "source_id", "source_rank", F.explode(F.array_distinct(F.concat(F.map_values("colmap"), F.coalesce("address_parts", F.array().cast("array<string>"))))).alias("title"))
    sizes = wanted.groupBy("source_id").agg(F.count(F.lit(1)).alias("n_wanted"))
    titles = signed.select("file", F.explode("titles").alias("title"))
    found = titles.join(F.broadcast(wanted), "title").groupBy("file", "source_id", "source_rank").agg(F.count(F.lit(1)).alias("n_found"))
    best = F.max(F.struct((F.col("n_found") / F.col("n_wanted")).alias("share"), "n_found", (-F.col("source_rank")).alias("order"), "source_id", "n_wanted"))
    return found.join(F.broadcast(sizes), "source_id").groupBy("file").agg(best.alias("b")).select("file", "b.source_id", "b.n_found", "b.n_wanted")
