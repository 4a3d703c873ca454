"""License registers: harmonise to sixteen text columns, merge duplicates, keep provenance."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placemill import vocab
from placemill.functions.dates import normalize_date
from placemill.functions.text import is_filled, join_filled, match_key, strip
from placemill.plans.accounting import RowCounts
from placemill.sources.inline import NUMBER, TEXT, inline_relation
from placemill.sources.registry import SourceSpec, registry_frame, registry_side

_DERIVED = ("geocoding_level", "sources", "licenses")
_MAPPED = [c for c in vocab.REGISTER_COLUMNS if c not in _DERIVED]
DATE_COLUMNS = ("license_date", "expire_date")
ORDER = ("source_rank", "row_pos")


def _finish(values: dict[str, Column], rows: DataFrame, source_id: Column, rank: Column, source_name: Column,
            license_: Column, dates: Sequence[str] = DATE_COLUMNS, extra: Sequence[str] = ()) -> DataFrame:
    """What follows mapping, address and constants, in this order: city fallback, dates, level, provenance,
    blank rows out. ``dates`` are the date columns that can hold anything."""
    mapped = rows.select(
        *[values[c].alias(c) for c in _MAPPED], source_name.alias("sources"), license_.alias("licenses"),
        source_id.alias("srcid"), rank.alias("source_rank"), "row_pos", *extra,
    )
    located = is_filled(F.col("lat")) & is_filled(F.col("lng"))
    return (
        mapped.where(is_filled(F.col("name")) | is_filled(F.col("address")))
        .withColumns({
            "city_raw": F.when(F.col("city_raw") == "", F.col("city")).otherwise(F.col("city_raw")),
            "geocoding_level": F.when(located, "source").otherwise(""),
            **{c: normalize_date(F.col(c)) for c in dates},
        })
        .select(*vocab.REGISTER_COLUMNS, "srcid", *ORDER, *extra)
    )


def normalize_frame(raw: DataFrame, spec: SourceSpec, rank: int = 0) -> DataFrame:
    """One register that is already a table of text columns plus ``row_pos``; reads only mapped columns."""
    raw = raw.toDF(*[c.strip() for c in raw.columns])
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    values: dict[str, Column] = {c: F.lit("") for c in _MAPPED}
    for target, column in spec.colmap.items():
        if column in raw.columns:
            values[target] = strip(text(column))
        else:
            warnings.warn(f"{spec.id}: no column {column!r}, {target} stays blank", stacklevel=2)
    parts = [p for p in spec.address_parts if p in raw.columns]
    if parts:
        values["address"] = join_filled([text(p) for p in parts])
    values.update({k: F.lit(v) for k, v in spec.const.items()})
    dates = [c for c in DATE_COLUMNS if c in spec.colmap or c in spec.const]
    return _finish(values, raw, F.lit(spec.id), F.lit(rank).cast("bigint"), F.lit(spec.source_name), F.lit(spec.license), dates)


def _settings(spark, specs: Sequence[SourceSpec] | DataFrame) -> DataFrame:
    """The registry, ready to be sent to every task if it is a list held by the caller, one entry per register:
    joining by shuffle would gather a large register's records in one task. A table of many registers is shuffled, and a
    large register left to adaptive execution."""
    return registry_side(specs, registry_frame(spark, specs))


def normalize_records(records: DataFrame, specs: Sequence[SourceSpec] | DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Records of any number of registers, each by its own registry entry; columns named in ``extra`` come along."""
    config = _settings(records.sparkSession, specs)
    rows = records.join(config.drop("pref", "muni", "route", "format", "path", "url", "encoding"), "source_id")

    def mapped(target: str) -> Column:
        column = F.try_element_at("colmap", F.lit(target))
        return F.coalesce(strip(F.try_element_at("record", column)), F.lit(""))

    present = F.filter("address_parts", lambda p: F.map_contains_key("record", p))
    pieces = F.filter(F.transform(present, lambda p: strip(F.try_element_at("record", p))), lambda x: x != "")
    address = F.when(F.size(present) > 0, F.array_join(pieces, " ")).otherwise(mapped("address"))
    values = {
        c: F.coalesce(F.try_element_at("const", F.lit(c)), address if c == "address" else mapped(c))
        for c in _MAPPED
    }
    return _finish(values, rows, F.col("source_id"), F.col("source_rank"), F.col("source_name"), F.col("license"), extra=extra)


def missing_columns(records: DataFrame, specs: Sequence[SourceSpec] | DataFrame) -> DataFrame:
    """Mapped columns a register's files lack: (source_id, target, column)."""
    titles = records.select("source_id", F.explode(F.map_keys("record")).alias("title")).groupBy("source_id").agg(
        F.collect_set("title").alias("titles"))
    wanted = registry_side(specs, registry_frame(records.sparkSession, specs).select("source_id", F.explode("colmap").alias("target", "column")))
    return titles.join(wanted, "source_id").where(~F.array_contains("titles", F.col("column"))).drop("titles")


def merge_register(rows: DataFrame) -> DataFrame:
    """One row per match key: the first row (source order, row order) gives the values; names, licenses and ids
    of all its sources are listed sorted.

    One shuffle. Partial aggregation folds copies before it, so a key with very many copies travels as one row
    per task; the sets hold source names, of which there are as many as registered sources.
    """
    values = [c for c in vocab.REGISTER_COLUMNS if c not in ("sources", "licenses")]

    def listed(c: str, sep: str) -> Column:
        return F.array_join(F.array_sort(F.collect_set(c)), sep).alias(c)

    order = F.struct(*ORDER)
    return (
        rows.withColumn("_k", match_key(F.col("name"), F.col("address"), F.col("business_type")))
        .groupBy("_k")
        .agg(
            F.min_by(F.struct(*values), order).alias("_first"), F.min(order).alias("first_seen"),
            listed("sources", "; "), listed("licenses", "; "), listed("srcid", ","),
            F.count(F.lit(1)).alias("n_rows"),
        )
        .select(*[F.col(f"_first.{c}").alias(c) for c in values], "sources", "licenses", "srcid", "n_rows", "first_seen")
        .select(*vocab.REGISTER_COLUMNS, "srcid", "n_rows", "first_seen")
    )


def in_encounter_order(merged: DataFrame) -> DataFrame:
    return merged.orderBy("first_seen")


def merge_summary(merged: DataFrame) -> DataFrame:
    return merged.agg(
        F.sum("n_rows").alias("rows_before"), F.count(F.lit(1)).alias("rows_after")
    ).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def counted_merge(merged: DataFrame, counted: RowCounts) -> DataFrame:
    """The merged register with its summary observed in the pass that writes it: rows that went in, and rows that came out."""
    return counted.after(counted.before(merged, F.col("n_rows")))


def source_counts(rows: DataFrame, specs: Sequence[SourceSpec]) -> DataFrame:
    """Coverage report: one line per registered source, also those without rows."""
    registry = registry_frame(rows.sparkSession, specs)
    counts = rows.groupBy("srcid").agg(F.count(F.lit(1)).alias("records"))
    records = F.coalesce(F.col("records"), F.lit(0))
    return registry.join(counts, registry["source_id"] == counts["srcid"], "left").select(
        "pref", "muni", "route", F.when(records > 0, "✅").otherwise("").alias("avail"),
        records.alias("records"), F.col("source_name").alias("source"), "license", "url",
    )


def column_completeness(merged: DataFrame, columns: Sequence[str] = vocab.REGISTER_COLUMNS) -> DataFrame:
    """Percentage of non-blank values per column, in one pass."""
    rates = merged.agg(*[
        F.round(F.avg(F.when(is_filled(F.col(c)), 1.0).otherwise(0.0)) * 100, 4).alias(c) for c in columns
    ])
    return rates.unpivot([], list(columns), "column_name", "filled_pct")


def area_match_rate(merged: DataFrame, areas: Sequence[tuple[str, Sequence[str], int | None]]) -> DataFrame:
    """Merged rows that carry any source of an area, against the area's reference count.

    A row is mapped to the areas of its sources in place and counted once per area; no join of rows.
    """
    spark = merged.sparkSession
    by_source: dict[str, list[str]] = {}
    for label, ids, _ in areas:
        for source in ids:
            by_source.setdefault(source, []).append(label)
    lookup = F.create_map(*[x for s, labels in by_source.items()
                            for x in (F.lit(s), F.array(*[F.lit(v) for v in labels]))])
    none = F.array().cast("array<string>")
    own = F.transform(F.split("srcid", ","), lambda s: F.coalesce(F.try_element_at(lookup, s), none))
    counts = merged.select(F.explode(F.array_distinct(F.flatten(own))).alias("area")).groupBy("area").agg(
        F.count(F.lit(1)).alias("n"))
    listed = inline_relation(spark, {"area": TEXT, "reference": NUMBER}, [(label, ref) for label, _, ref in areas])
    n = F.coalesce(F.col("n"), F.lit(0))
    return listed.join(counts, "area", "left").select(
        "area", "reference", n.alias("n"),
        F.when(F.col("reference") > 0, F.round(n / F.col("reference") * 100, 4)).alias("match_pct"),
    )


def register_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Difference of two merged snapshots by match key: added, removed or changed."""
    def keyed(df, tag):
        body = F.sha2(F.to_json(F.struct(*vocab.REGISTER_COLUMNS)), 256)
        return df.select(match_key(F.col("name"), F.col("address"), F.col("business_type")).alias("match_key"),
                         body.alias(tag))

    both = keyed(old, "old_body").join(keyed(new, "new_body"), "match_key", "full_outer")
    kind = (
        F.when(F.col("old_body").isNull(), "added").when(F.col("new_body").isNull(), "removed")
        .when(F.col("old_body") != F.col("new_body"), "changed")
    )
    return both.select("match_key", kind.alias("change")).where(F.col("change").isNotNull())
