"""Register files of any encoding and layout as one stream of records.

Files are the unit of parallelism: ``binaryFile`` spreads them over tasks, each task turns its files into chunks of text records, and
Spark expressions parse these to ``map<column, text>``. All sources, however many, are one scan and one
decode step driven by the registry relation, not one plan branch per source.
"""

from __future__ import annotations

import codecs
import csv
import io
import re
from collections.abc import Iterator, Sequence
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placemill.session import shuffled
from placemill.sources.registry import CSV_FORMATS, SourceSpec, path_key, registry_frame, registry_side
from placemill.sources.xlsx import sheet_rows

CHUNK_ROWS = 5000


_MARKS = ((codecs.BOM_UTF8, "utf-8-sig"), (codecs.BOM_UTF32_LE, "utf-32"), (codecs.BOM_UTF32_BE, "utf-32"),
          (codecs.BOM_UTF16_LE, "utf-16"), (codecs.BOM_UTF16_BE, "utf-16"))


def _strictly(content: bytes, encoding: str) -> str | None:
    try:
        return content.decode(encoding)
    except UnicodeDecodeError:
        return None


def decode_text(content: bytes, encoding: str | None) -> str:
    """Declared encoding with bad bytes replaced; else the byte-order mark; else strict UTF-8; else whichever of cp932 and
    EUC-JP reads the bytes with fewer half-width kana, which is how one looks when read as the other."""
    if encoding is not None:
        return content.decode(encoding, errors="replace")
    for mark, named in _MARKS:
        if content.startswith(mark):
            return content.decode(named)
    text = _strictly(content, "utf-8")
    if text is not None:
        return text
    readings = [t for t in (_strictly(content, "cp932"), _strictly(content, "euc_jp")) if t is not None]
    if not readings:
        raise ValueError("text in no known encoding: declare one in the registry")
    return min(readings, key=lambda t: sum("\uff61" <= c <= "\uff9f" for c in t))


# one record of a text file: fields that begin with a quote may hold line breaks
_QUOTED = r'"(?:[^"]|"")*+"[^,\r\n]*'
_FIELD = rf'(?:{_QUOTED}|[^,\r\n]*)'
_RECORD = re.compile(rf"({_FIELD}(?:,{_FIELD})*+)(?:\r\n|\n|\r|\Z)")
_BREAK = re.compile(r"\r\n|\n|\r")


def _records(text: str) -> Iterator[str]:
    """The records of a text that are not blank, as they stand."""
    if '"' not in text:
        found = iter(_BREAK.split(text))
    else:
        found = (m[1] for m in _RECORD.finditer(text))
    return (r for r in found if r and not r.isspace())


def _csv_chunks(content: bytes, encoding: str | None, header_row: int, source_id: str) -> Iterator[tuple[list[str], list]]:
    try:
        text = decode_text(content, encoding)
    except (ValueError, LookupError) as e:
        raise ValueError(f"{source_id}: {e}") from e
    records = _records(text)
    head = next(islice(records, header_row, None), "")
    titles = next(csv.reader(io.StringIO(head, newline="")), [])
    while lines := list(islice(records, CHUNK_ROWS)):
        yield titles, lines


def _sheet_chunks(content: bytes, header_row: int, sheet: str) -> Iterator[tuple[list[str], list]]:
    rows = sheet_rows(content, int(sheet[1:]) if sheet.startswith("#") else sheet)
    titles = next(islice(rows, header_row, None), [])
    filled = ([str(c) for c in row] for row in rows if any(row))
    while cells := list(islice(filled, CHUNK_ROWS)):
        yield titles, cells


_CHUNKS = "source_id string, start bigint, titles array<string>, places array<int>, lines array<string>, cells array<array<string>>"


def _chunk(source_id: str, start: int, titles: list[str], lines: list | None, cells: list | None) -> pa.RecordBatch:
    """Titles are stripped, and of equal ones the first counts; ``places`` are their columns."""
    kept: dict[str, int] = {}
    for place, title in enumerate(titles):
        kept.setdefault(str(title).strip(), place)
    values = [(source_id, pa.string()), (start, pa.int64()), (list(kept), pa.list_(pa.string())), (list(kept.values()), pa.list_(pa.int32())),
              (lines, pa.list_(pa.string())), (cells, pa.list_(pa.list_(pa.string())))]
    return pa.record_batch([pa.array([v], kind) for v, kind in values], names=[c.split()[0] for c in _CHUNKS.split(", ")])


def _transcode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            file = batch.slice(i, 1).to_pylist()[0]
            text = file["format"] in CSV_FORMATS
            if text:
                chunks = _csv_chunks(file["content"], file["encoding"], file["header_row"], file["source_id"])
            else:
                chunks = _sheet_chunks(file["content"], file["header_row"], file["sheet"])
            start = 0
            for titles, rows in chunks:
                yield _chunk(file["source_id"], start, titles, rows if text else None, None if text else rows)
                start += len(rows)


def fields_of(record: Column) -> Column:
    """The fields of a record as an array: a field that begins with a quote ends at the next single one, doubled quotes inside are one."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(r',("(?:[^"]|"")*+"[^,]*|[^,]*)'), F.lit(1))
    unquoted = lambda f: F.replace(F.regexp_replace(f, r'^"((?:[^"]|"")*+)"', "$1"), F.lit('""'), F.lit('"'))
    return F.transform(raw, lambda f: F.when(f.startswith('"'), unquoted(f)).otherwise(f))


def decode_files(files: DataFrame) -> DataFrame:
    """(source_id, format, encoding, header_row, sheet, content) to (source_id, row_pos, record).

    Python turns bytes into text and tells records apart, and opens workbooks, the only kind that Spark has no reader for; fields
    are parsed and named by expressions. Chunks of records are exploded, so a file's records may be spread over tasks from there on.
    """
    needed = files.select("source_id", "format", "encoding", "header_row", "sheet", "content")
    chunks = needed.mapInArrow(_transcode, _CHUNKS)
    settled = chunks.select("source_id", "start", "titles", "places", F.posexplode(F.coalesce(
        F.transform("lines", lambda line: F.struct(line.alias("line"), F.lit(None).cast("array<string>").alias("cells"))),
        F.transform("cells", lambda c: F.struct(F.lit(None).cast("string").alias("line"), c.alias("cells"))))).alias("at", "row"))
    values = settled.withColumn("values", F.coalesce("row.cells", fields_of(F.col("row.line"))))
    named = F.transform("places", lambda p: F.coalesce(F.get("values", p), F.lit("")))
    return values.select("source_id", (F.col("start") + F.col("at")).alias("row_pos"), F.map_from_arrays("titles", named).alias("record"))


def with_file_settings(files: DataFrame, specs: Sequence[SourceSpec] | DataFrame) -> DataFrame:
    """Attach the registry settings to listed files by path; a file gets one row per entry that names it. If the registry is
    the caller's own list, the file contents stay where they are and the settings are broadcast."""
    settings = registry_frame(files.sparkSession, specs).select(
        path_key(F.col("path")).alias("_key"), "source_id", "format", "encoding", "header_row", "sheet")
    return files.select(path_key(F.col("path")).alias("_key"), "content").join(registry_side(specs, settings), "_key")


def listed_files(spark: SparkSession, folder: str) -> DataFrame:
    """All files below a folder."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)


def scan_registers(spark: SparkSession, specs: Sequence[SourceSpec] | DataFrame, folder: str | None = None) -> DataFrame:
    """Records of all registered files in one scan. A path that several entries name is read once; an entry without a file
    is an error. A registry that is a table needs the ``folder`` that its files lie below; others there are left out."""
    if isinstance(specs, DataFrame):
        files = listed_files(spark, folder)
    else:
        files = spark.read.format("binaryFile").load(list(dict.fromkeys(s.path for s in specs)))
    keys = registry_frame(spark, specs).select("source_id", path_key(F.col("path")).alias("_key"))
    missing = keys.join(shuffled(files.select(path_key(F.col("path")).alias("_key"))), "_key", "left_anti").select("source_id").collect()
    if missing:
        raise FileNotFoundError(f"no file for {sorted(r['source_id'] for r in missing)}")
    return decode_files(with_file_settings(files, specs))


def scan_utf8_csv(spark: SparkSession, path: str) -> DataFrame:
    """A UTF-8 register by the built-in reader: quoted line breaks, all text, '' for missing."""
    df = spark.read.csv(path, header=True, multiLine=True, escape='"', encoding="UTF-8", inferSchema=False)
    return df.toDF(*[c.strip("\ufeff").strip() for c in df.columns]).fillna("")
