"""The input views as Spark frames, and register files built from the tables."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placemill.operators.registers import normalize_frame
from placemill.session import scratch_path, shuffled, stable
from placemill.sources.registers import listed_files
from placemill.sources.registry import SourceSpec
from placemill_checks import views


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_written: dict[tuple[str, str, str], DataFrame] = {}
SPREAD_ROWS = 100_000


def _spread(df: DataFrame) -> DataFrame:
    """The rows dealt out evenly: the tables are so few files, and so well compressed, that a scan of them is one task or two, which all that
    is made of their rows would stay in."""
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // SPREAD_ROWS))
    return df.repartition(parts)


def _derived(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A view as the parquet table a pipeline step would have left: derived from the test tables and written
    to the shared folder once per application, so that queries start from a scan."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        _written[key] = stable(_spread(build()), name)
    return _written[key]


def prepare(spark: SparkSession, sf_dir: str) -> None:
    """Write all views."""
    for view in (places, raw_places, community, areas):
        view(spark, sf_dir)
    for which in ("reg_a", "reg_b"):
        register(spark, sf_dir, which)


def _sql(spark: SparkSession, sf_dir: str, sql: str, name: str) -> DataFrame:
    return spark.sql(sql, **{name: table(spark, sf_dir, name)})


def _tags(csv: str):
    return F.split(csv, ",")


def _datasets():
    return F.array(F.lit("Overture"), "provider")


def _place(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, "place", lambda: _sql(spark, sf_dir, views.PLACE, "orders"))


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat places with tag and dataset arrays."""
    def build():
        return _place(spark, sf_dir).select(
            "id", "name", "category", _tags("alt_csv").alias("category_alt"), "confidence", "brand_wikidata",
            "brand_name", "operating_status", "country", "region", "locality", "address",
            _datasets().alias("datasets"), "lon", "lat",
        )

    return _derived(spark, sf_dir, "places", build)


def raw_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested places as the extraction reads them."""
    def build():
        flat = spark.sql(views.RAW_PLACE.replace("FROM place", "FROM {place}"), place=_place(spark, sf_dir))
        here = F.struct("country", "region", "locality", F.col("address").alias("freeform"))
        other = F.struct(F.lit("XX").alias("country"), F.lit("r").alias("region"), F.lit("l").alias("locality"),
                         F.lit("f").alias("freeform"))
        return flat.select(
            "id", F.struct(F.col("name").alias("primary")).alias("names"),
            F.struct(F.col("category").alias("primary"), _tags("alt_csv").alias("alternate")).alias("categories"),
            "confidence",
            F.struct(F.col("brand_wikidata").alias("wikidata"),
                     F.struct(F.col("brand_name").alias("primary")).alias("names")).alias("brand"),
            "operating_status",
            F.slice(F.array(here, other), F.lit(1), F.col("n_addresses")).alias("addresses"),
            F.transform(_datasets(), lambda d: F.struct(d.alias("dataset"))).alias("sources"),
            F.struct(F.col("lon").alias("xmin"), F.col("lat").alias("ymin")).alias("bbox"),
        )

    return _derived(spark, sf_dir, "raw_places", build)


def community(spark: SparkSession, sf_dir: str) -> DataFrame:
    build = lambda: _sql(spark, sf_dir, views.COMMUNITY, "orders")
    return _derived(spark, sf_dir, "community", build).withColumnsRenamed({"lon_s": "@lon", "lat_s": "@lat"})


def region_edges(spark: SparkSession) -> DataFrame:
    return spark.sql(views.REGION_EDGES).withColumnRenamed("by_", "by")


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, "areas", lambda: _sql(spark, sf_dir, views.AREA, "customer"))


def area_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pref, rings): each ring closed, as in a polygon layer."""
    def ring(size: str):
        x, y, s = F.col("mx"), F.col("my"), F.col(size)
        corners = [(x - s, y), (x, y - s), (x + s, y), (x, y + s), (x - s, y)]
        return F.array(*[F.array(a, b) for a, b in corners])

    return areas(spark, sf_dir).select("pref", F.array(ring("half"), ring("hole")).alias("rings"))


# fixed values: how the register views map to the common columns
REGISTER_COLUMNS = {
    "name": "facility_name", "business_type": "biz", "lat": "lat_s", "lng": "lng_s", "license_no": "lic",
    "license_date": "lic_date", "phone": "no_such_column",
}


def register_specs() -> list[SourceSpec]:
    return [
        SourceSpec("reg_a", "P1", "M1", "own", "Register A", "CC BY 4.0", "csv", "/registers/a.csv",
                   const={"prefecture": "P1", "city": "M1"}, colmap=REGISTER_COLUMNS, address_parts=("addr1", "addr2")),
        SourceSpec("reg_b", "P1", "M1", "shared", "Register B", "PDL 1.0", "csv", "/registers/b.csv",
                   const={"prefecture": "P1", "city": "M1", "city_raw": "M1 raw"}, colmap=REGISTER_COLUMNS,
                   address_parts=("addr1", "addr2")),
    ]


def register(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    sql = {"reg_a": views.REGISTER_A, "reg_b": views.REGISTER_B}[which]
    return _derived(spark, sf_dir, which, lambda: _sql(spark, sf_dir, sql, "customer"))


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, views.GAZETTEER, "nation")


def located_register(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    """(id, name, lon, lat): a register's shops where their areas lie; register B's are a little off."""
    off = 0.0 if which == "reg_a" else 0.0011
    spots = areas(spark, sf_dir).select(F.split_part("pref", F.lit(" "), F.lit(2)).cast("bigint").alias("id"), (F.col("mx") + off).alias("lon"),
                                        (F.col("my") + off).alias("lat"))
    names = register(spark, sf_dir, which).select(F.col("row_pos").alias("id"), F.col("facility_name").alias("name"))
    return names.join(shuffled(spots), "id")


DELIVERIES = 4


def delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Register A, harmonised, in deliveries d1 to d4: a shop is missing where (its number * n) mod 7 is 3, and has another license from
    d3 on where its number is a multiple of 9. ``srcid`` names the delivery, too."""
    rows = normalize_frame(register(spark, sf_dir, "reg_a"), register_specs()[0]).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(DELIVERIES))))
    rows = rows.where((F.col("row_pos") * F.col("n")) % 7 != 3).withColumn(
        "license_no", F.when((F.col("n") >= 3) & (F.col("row_pos") % 9 == 0), F.concat("license_no", F.lit("x"))).otherwise(F.col("license_no")))
    delivery = F.concat(F.lit("d"), F.col("n").cast("string"))
    return rows.withColumns({"delivery": delivery, "srcid": delivery}).drop("n")


VARIED_ROWS = 50


def varied_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small files of register B whose columns vary with their number: one of the first five columns is missing, every third file has
    columns of its own, every fourth is in cp932, and every fifth has a title row."""
    rows = register(spark, sf_dir, "reg_b").withColumn("file_no", F.floor(F.col("row_pos") / VARIED_ROWS))
    number, columns = F.col("file_no"), F.array(*map(F.lit, FILE_COLUMNS))
    titles = F.filter(columns, lambda c, i: i != number % 5)
    titles = F.when(number % 3 == 0, F.concat(titles, F.array(F.lit("own"), F.concat(F.lit("own "), (number % 4).cast("string"))))).otherwise(titles)
    line = F.concat_ws(",", F.col("row_pos").cast("string"), *[F.lit("x")] * 5)
    text = rows.groupBy("file_no").agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("body"))  # VARIED_ROWS rows at most
    whole = F.concat(F.when(number % 5 == 0, "Title row\n").otherwise(""), F.array_join(titles, ","), F.lit("\n"), F.col("body"))
    content = F.when(number % 4 == 0, to_plain_cp932(whole)).otherwise(F.encode(whole, "UTF-8"))
    return text.select(F.concat(F.lit("file-"), number.cast("string")).alias("file"), F.lit("csv").alias("format"), F.lit(None).cast("string").alias("encoding"),
                       F.lit("#0").alias("sheet"), content.alias("content"))


def varied_specs() -> list[SourceSpec]:
    return [SourceSpec(f"known-{k}", "P1", "M1", "own", "Known", "L", "csv", f"/known/{k}.csv",
                       colmap={"name": "facility_name", "license_no": "lic", "phone": f"own {k}"}, address_parts=("addr1", "addr2")[:1 + k % 2]) for k in range(4)]


# ---- register files built from the register views: one file per 500 shops -----------------------
FILE_ROWS = 500
FILE_COLUMNS = ["facility_name", "addr1", "addr2", "biz", "lic", "lat_s", "lng_s", "lic_date"]


def _csv_text(rows: DataFrame, encode) -> DataFrame:
    quoted = [F.concat(F.lit('"'), F.regexp_replace(F.col(c), '"', '""'), F.lit('"')) for c in FILE_COLUMNS]
    line = F.concat_ws(",", *quoted)
    # a file holds at most FILE_ROWS rows by construction of its number
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_pos", line.alias("line")))),
                                    lambda r: r["line"]), "\r\n")
    return rows.groupBy("file_no").agg(encode(F.concat(F.lit(",".join(FILE_COLUMNS) + "\r\n"), body)).alias("content"))


@F.pandas_udf(T.BinaryType())
def to_plain_cp932(text: pd.Series) -> pd.Series:
    return text.map(lambda s: s.encode("cp932"))


@F.pandas_udf(T.BinaryType())
def to_cp932(text: pd.Series) -> pd.Series:
    return text.map(lambda s: ("Title row\r\n" + s).encode("cp932"))


def workbook(rows: list[list[str]], title: str = "Sheet1") -> bytes:
    """A minimal workbook with inline text cells."""
    def cell(r, c, v):
        return f'<c r="{chr(65 + c)}{r}" t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>'

    sheet = "".join(
        f'<row r="{r}">' + "".join(cell(r, c, v) for c, v in enumerate(row)) + "</row>" for r, row in enumerate(rows, 1)
    )
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>'
                   f'<sheet name="{title}" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels",
                   '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   f'<Relationship Id="rId1" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData>{sheet}</sheetData></worksheet>')
    return out.getvalue()


@F.pandas_udf(T.BinaryType())
def to_workbook(text: pd.Series) -> pd.Series:
    import csv

    return text.map(lambda s: workbook([["Title row"], *csv.reader(io.StringIO(s, newline=""))]))


def register_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of four kinds as (source_id, format, encoding, header_row, sheet, content): UTF-8 with byte-order
    mark, undeclared cp932, declared cp932 under a title row, workbook under a title row."""
    rows = register(spark, sf_dir, "reg_b").withColumn("file_no", F.floor(F.col("row_pos") / FILE_ROWS))
    utf8 = lambda c: F.concat(F.unhex(F.lit("EFBBBF")), F.encode(c, "UTF-8"))
    kinds = [("utf8", "csv", None, 0, utf8), ("sjis", "csv", None, 1, to_cp932),
             ("sjis_declared", "fas", "cp932", 1, to_cp932), ("book", "excel", None, 1, to_workbook)]
    text = _csv_text(rows, lambda c: c)
    files = None
    for source, fmt, encoding, header_row, encode in kinds:
        part = text.select(
            F.concat_ws("-", F.lit(source), "file_no").alias("source_id"), F.lit(fmt).alias("format"),
            F.lit(encoding).cast("string").alias("encoding"), F.lit(header_row).alias("header_row"),
            F.lit("#0").alias("sheet"), encode(F.col("content")).alias("content"))
        files = part if files is None else files.unionByName(part)
    return files


_landed: dict[tuple[str, str], tuple[DataFrame, str]] = {}
KINDS = ("utf8", "sjis", "sjis_declared", "book")


def _land(files: DataFrame, folder: str, end: str) -> None:
    """One file per row, written by tasks: the text writer puts out bytes as they are, and ``end`` after them."""
    rows = files.select("source_id", F.col("content").cast("string").alias("value"))
    rows.write.option("lineSep", end).partitionBy("source_id").text(folder)


def landed_registers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """The registry of the register files, as a table, and the folder below the shared one that they lie in, written once per application.
    Each file is bounded (FILE_ROWS), their number grows with the data; neither they nor their entries pass through the driver."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landed:
        folder, files = scratch_path(spark, "landed"), register_files(spark, sf_dir)
        settings = files.drop("content")
        _land(files.where("format <> 'excel'"), f"{folder}/text", "\r\n")
        # a workbook ends with the length of its comment, which is 0 in two bytes
        books = files.where("format = 'excel'").withColumn("content", F.expr("substring(content, 1, octet_length(content) - 2)"))
        _land(books, f"{folder}/books", "\0\0")
        paths = listed_files(spark, folder).select("path", F.regexp_extract("path", r"/source_id=([^/]+)/", 1).alias("source_id"))
        text = lambda value: F.lit(value).cast("string")
        pairs = lambda m: F.create_map(*[F.lit(x) for pair in m.items() for x in pair])
        kind, number = F.substring_index("source_id", "-", 1), F.substring_index("source_id", "-", -1).cast("bigint")
        columns = {
            "source_id": F.col("source_id"), "source_rank": number * len(KINDS) + F.array_position(F.array(*map(F.lit, KINDS)), kind) - 1,
            "pref": text("P1"), "muni": text("M1"), "route": text("own"), "source_name": F.concat(F.lit("Register "), "source_id"),
            "license": text("CC BY 4.0"), "format": F.col("format"), "path": F.col("path"), "url": text(""), "encoding": F.col("encoding"),
            "header_row": F.col("header_row").cast("bigint"), "sheet": F.col("sheet"), "const": pairs({"prefecture": "P1", "city": "M1"}),
            "colmap": pairs(REGISTER_COLUMNS), "address_parts": F.array(F.lit("addr1"), F.lit("no_such_part"), F.lit("addr2")),
        }
        entries = paths.join(shuffled(settings), "source_id", "right").select(*[c.alias(name) for name, c in columns.items()])
        _landed[key] = (stable(entries, "registry"), folder)
    return _landed[key]
