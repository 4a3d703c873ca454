"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placemill import vocab
from placemill.functions.classify import chain_of, chain_or_other, is_branded
from placemill.functions.dates import normalize_date
from placemill.operators import branches, features, gazetteer, history, linkage, providers, registers, signatures, thinning, tiles
from placemill.operators.extract import extract_places
from placemill.operators.nearest import nearest_neighbours
from placemill.operators.numbering import number_rows
from placemill.operators.regions import assign_region, build_region_index, tally_regions
from placemill.plans import master as M
from placemill.plans import reports
from placemill.plans.accounting import RowCounts
from placemill.plans.registers import harmonised_rows
from placemill.session import scratch_path, shuffled, stable
from placemill.sinks.features import write_geojson_lines
from placemill.sinks.layout import write_clustered
from placemill.sinks.tables import write_master, write_parquet, write_register_csv
from placemill.sources import places as scans
from placemill.sources.registers import scan_registers
from placemill.streaming import buckets
from placemill_checks import frames

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
AREAS = [("both", ("reg_a", "reg_b"), 1000), ("A", ("reg_a",), 1200), ("B", ("reg_b",), None), ("none", ("reg_z",), 10)]


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def deduped(spark, d):
    return providers.keep_best_provider(frames.places(spark, d))


def _joined_tags(df):
    return df.withColumn("category_alt", F.array_join("category_alt", "|"))


# ---- extraction and providers -------------------------------------------------------------------
@query
def extract_flatten(spark, d):
    return _joined_tags(extract_places(frames.raw_places(spark, d))).withColumn("datasets", F.array_join("datasets", "|"))


@query
def chain_classify(spark, d):
    name = F.col("name")
    return frames.places(spark, d).select(
        "id", "name", chain_of(name).alias("chain"), chain_or_other(name).alias("chain_or_other"),
        is_branded(name).alias("branded"))


@query
def dedup_best_provider(spark, d):
    return _joined_tags(deduped(spark, d))


@query
def best_provider_by_chain(spark, d):
    return providers.best_provider_by_chain(frames.places(spark, d))


@query
def provider_composition(spark, d):
    return providers.provider_composition(frames.places(spark, d))


@query
def country_composition(spark, d):
    return providers.country_composition(frames.places(spark, d))


@query
def inline_dimension(spark, d):
    best = providers.chain_provider_table(spark)
    counts = frames.places(spark, d).groupBy(chain_of(F.col("name")).alias("chain")).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(best, "chain", "left").select("chain", "provider", "n")


# ---- comparison reports -------------------------------------------------------------------------
def _comparison(spark, d):
    return reports.compare_sources(deduped(spark, d), frames.community(spark, d))


@query
def compare_sources(spark, d):
    return _comparison(spark, d)


@query
def compare_sources_total(spark, d):
    return reports.compare_with_total(_comparison(spark, d))


@query
def report_spine(spark, d):
    counts = deduped(spark, d).groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    bucket = reports.category_bucket(F.col("category"))
    return reports.report_spine(spark).join(
        counts.select(bucket.alias("bucket"), "category", "n"), "bucket", "left"
    ).select("ord", "label", "category", F.coalesce("n", F.lit(0)).alias("n"))


@query
def coverage_ratio(spark, d):
    return reports.coverage_ratio(_comparison(spark, d))


@query
def union_inflation(spark, d):
    return reports.union_inflation(frames.places(spark, d), frames.community(spark, d), dict(vocab.OFFICIAL_COUNTS)["conv"])


# ---- near duplicates ----------------------------------------------------------------------------
@query
def spatial_dup_report(spark, d):
    return branches.duplicate_report(frames.places(spark, d))


@query
def spatial_dup_flags(spark, d):
    return branches.flag_duplicates(branches.with_chain_and_branch(frames.places(spark, d))).select(
        "id", "chain", "branded", "is_duplicate")


@query
def capture_rate_by_radius(spark, d):
    return branches.capture_rate(frames.places(spark, d), (50.0, 100.0, 500.0))


@query
def nearest_branch(spark, d):
    """The neighbour itself and its distance, within two kilometres."""
    found = branches.nearest_branches(branches.with_chain_and_branch(frames.places(spark, d)), 2000.0)
    return found.select("id", "other_id", F.round("metres", 3).alias("metres"))


@query
def nearest_three_shops(spark, d):
    """The three nearest convenience stores of each supermarket within a kilometre, whatever their chain."""
    places = frames.places(spark, d)
    of = lambda category: places.where(F.col("category") == category).select("id", "lon", "lat")
    found = nearest_neighbours(of("supermarket"), of("convenience_store"), 1000.0, 3)
    return found.select("id", F.posexplode_outer("neighbours").alias("pos", "n")).select(
        "id", (F.col("pos") + 1).alias("nth"), F.col("n.id").alias("other_id"), F.round("n.metres", 3).alias("metres"))


@query
def fuzzy_link(spark, d):
    """Shops of register A and B up to two edits and twenty kilometres apart."""
    return linkage.fuzzy_link(frames.located_register(spark, d, "reg_a"), frames.located_register(spark, d, "reg_b"), 20_000.0, 2)


@query
def noise_purge(spark, d):
    return M.clean_groceries(frames.places(spark, d)).select("id", "name")


@query
def spatial_anti_join_grocery(spark, d):
    return M.unique_groceries(frames.places(spark, d))


@query
def spatial_anti_join_fresh(spark, d):
    return M.unique_community_fresh(frames.places(spark, d), frames.community(spark, d))


# ---- regions and master -------------------------------------------------------------------------
@query
def assign_region_of_place(spark, d):
    index = build_region_index(frames.region_edges(spark))
    return assign_region(frames.places(spark, d).select("id", "lon", "lat"), index).select("id", "pref")


@query
def assign_shop_area(spark, d):
    """Many overlapping polygons with holes, one per customer."""
    edges = scans.ring_edges(frames.area_rings(spark, d))
    points = frames.places(spark, d).select("id", "lon", "lat")
    return assign_region(points, build_region_index(edges)).select("id", "pref")


def _candidates(spark, d):
    return M.candidates(deduped(spark, d), frames.community(spark, d))


@query
def assign_chain_area(spark, d):
    """The same polygons under twenty names: features of one name overlap, and each counts."""
    number = F.split_part("pref", F.lit(" "), F.lit(2)).cast("bigint")
    rings = frames.area_rings(spark, d).withColumn("pref", F.concat(F.lit("group "), (number % 20).cast("string")))
    points = frames.places(spark, d).select("id", "lon", "lat")
    return assign_region(points, build_region_index(scans.ring_edges(rings))).select("id", "pref")


@query
def build_master(spark, d):
    return M.build_master(deduped(spark, d), frames.community(spark, d), frames.region_edges(spark))


@F.pandas_udf(T.StructType([T.StructField("lng", T.DoubleType()), T.StructField("lat", T.DoubleType())]))
def _point(wkb: pd.Series) -> pd.DataFrame:
    layout = np.dtype([("order", "u1"), ("kind", "<u4"), ("lng", "<f8"), ("lat", "<f8")])
    points = np.frombuffer(b"".join(wkb), layout)
    return pd.DataFrame({"lng": points["lng"], "lat": points["lat"]})


@query
def master_files(spark, d):
    """The master's two files read back: coordinates from the WKB points and from the CSV."""
    parquet, csv = scratch_path(spark, "master"), scratch_path(spark, "master")
    write_master(build_master(spark, d), parquet, csv)
    points = spark.read.parquet(parquet).select("store_id", "cat", "src", "prefecture", _point("geom").alias("p"))
    text = spark.read.csv(csv, header=True, escape='"').select(
        F.col("store_id").cast("bigint"), F.col("lng").cast("double").alias("csv_lng"), F.col("lat").cast("double").alias("csv_lat"))
    return points.join(shuffled(text), "store_id").select(
        "store_id", "cat", "src", "prefecture", F.col("p.lng").alias("wkb_lng"), F.col("p.lat").alias("wkb_lat"), "csv_lng", "csv_lat")


@query
def master_counted(spark, d):
    """Categories of the master beside the row accounting of the pass that wrote it; no row is counted a second time for it."""
    counted = RowCounts()
    master = M.build_master(deduped(spark, d), frames.community(spark, d), frames.region_edges(spark), counted=counted)
    return master.groupBy("cat").agg(F.count(F.lit(1)).alias("n")).select(
        "cat", "n", F.lit(counted.n_before).alias("n_candidates"), F.lit(counted.n_after).alias("n_master"), F.lit(counted.n_dropped).alias("n_dropped"))


@query
def master_counts(spark, d):
    return reports.master_counts(M.locate(_candidates(spark, d), frames.region_edges(spark)))


@query
def row_accounting(spark, d):
    return reports.row_accounting(tally_regions(_candidates(spark, d), build_region_index(frames.region_edges(spark))))


# ---- registers ----------------------------------------------------------------------------------
def harmonised(spark, d):
    parts = [
        registers.normalize_frame(frames.register(spark, d, spec.id), spec, rank)
        for rank, spec in enumerate(frames.register_specs())
    ]
    return reduce(DataFrame.unionByName, parts)


def merged(spark, d):
    return registers.merge_register(harmonised(spark, d))


@query
def date_normalize(spark, d):
    rows = frames.register(spark, d, "reg_a").select("row_pos", F.col("lic_date").alias("raw_date"))
    return rows.withColumn("norm_date", normalize_date(F.col("raw_date")))


@query
def register_normalize(spark, d):
    return harmonised(spark, d)


@query
def register_merge(spark, d):
    return merged(spark, d).drop("first_seen")


@query
def register_order(spark, d):
    """The merged register numbered in the order its keys were first met."""
    return number_rows(merged(spark, d).select("first_seen", "name", "address", "business_type"), "position", ["first_seen"]).drop("first_seen")


@query
def merge_summary(spark, d):
    return registers.merge_summary(merged(spark, d))


@query
def column_completeness(spark, d):
    return registers.column_completeness(merged(spark, d))


@query
def source_counts(spark, d):
    return registers.source_counts(harmonised(spark, d), frames.register_specs())


@query
def area_match_rate(spark, d):
    return registers.area_match_rate(merged(spark, d), AREAS)


@query
def register_diff(spark, d):
    """Register A as the old snapshot of one source, B as its new one."""
    spec = frames.register_specs()[0]
    old, new = (
        registers.merge_register(registers.normalize_frame(frames.register(spark, d, which), spec)) for which in ("reg_a", "reg_b")
    )
    return registers.register_changes(old, new)


@query
def municipality_of_address(spark, d):
    rows = harmonised(spark, d).select("srcid", "row_pos", "address")
    return gazetteer.municipality_of_address(rows, frames.gazetteer(spark, d))


def _municipalities(spark, d):
    """Register A outside the towns that begin with 1, and the gazetteer."""
    rows = harmonised(spark, d).where("srcid = 'reg_a' AND address NOT LIKE 'Town 1%'").select("address")
    return gazetteer.municipality_of_address(rows, frames.gazetteer(spark, d)), frames.gazetteer(spark, d)


@query
def municipality_coverage(spark, d):
    return gazetteer.coverage_by_level(*_municipalities(spark, d))


@query
def municipality_gaps(spark, d):
    return gazetteer.coverage_gaps(*_municipalities(spark, d))


@query
def register_history(spark, d):
    """Register A over four deliveries in which shops are missing now and then and licenses change."""
    merged = registers.merge_register(frames.delivered(spark, d).drop("delivery").withColumn("name", F.concat_ws("@", "name", "srcid")))
    states = merged.select("*", F.split_part("name", F.lit("@"), F.lit(2)).alias("delivery")).withColumn("name", F.split_part("name", F.lit("@"), F.lit(1)))
    return history.register_history(history.keyed_states(states.withColumns({"sources": F.lit(""), "licenses": F.lit("")})))


@query
def register_refresh(spark, d):
    """The bucketed register after four deliveries, one after the other."""
    path, rows = scratch_path(spark, "refreshed"), frames.delivered(spark, d).withColumn("srcid", F.lit("reg_a"))
    for n in range(1, frames.DELIVERIES + 1):
        buckets.refresh(rows.where(F.col("delivery") == f"d{n}"), path, 16)
    return buckets.merged_buckets(spark, path).drop("first_seen")


@query
def file_signatures(spark, d):
    signed = signatures.file_signatures(frames.varied_files(spark, d))
    return signed.select("file", F.array_join("titles", "|").alias("titles"), "signature")


@query
def near_signatures(spark, d):
    signed = signatures.file_signatures(frames.varied_files(spark, d))
    return signatures.near_signatures(signed, 0.75).select("signature", "other", F.round("jaccard", 6).alias("jaccard"))


@query
def mapping_proposals(spark, d):
    return signatures.propose_mappings(signatures.file_signatures(frames.varied_files(spark, d)), frames.varied_specs())


@query
def registry_missing(spark, d):
    registry, folder = frames.landed_registers(spark, d)
    return registers.missing_columns(scan_registers(spark, registry, folder), registry)


@query
def registry_scan(spark, d):
    """Files of four kinds found by path, decoded and harmonised by the registry relation: all columns, source and row order."""
    return harmonised_rows(spark, *frames.landed_registers(spark, d)).drop("source_rank")


@query
def merge_counted(spark, d):
    """The merged register as written, by source list, beside the summary observed while it was written."""
    counted = RowCounts()
    written = stable(registers.counted_merge(merged(spark, d), counted), "merged")
    return written.groupBy("srcid").agg(F.count(F.lit(1)).alias("n")).select(
        "srcid", "n", F.lit(counted.n_before).alias("rows_before"), F.lit(counted.n_after).alias("rows_after"), F.lit(counted.n_dropped).alias("rows_removed"))


# ---- map features and tiles ---------------------------------------------------------------------
_FEATURE = """
    type string, geometry struct<type: string, coordinates: array<double>>,
    properties struct<name: string, cat: string, cat_raw: string, confidence: double>
"""


def _feature_fields(df, column):
    f = F.from_json(column, _FEATURE)
    return df.select(
        f["type"].alias("type"), f["geometry"]["type"].alias("geometry_type"),
        F.get(f["geometry"]["coordinates"], F.lit(0)).alias("lon"), F.get(f["geometry"]["coordinates"], F.lit(1)).alias("lat"),
        f["properties"]["name"].alias("name"), f["properties"]["cat"].alias("cat"),
        f["properties"]["cat_raw"].alias("cat_raw"), f["properties"]["confidence"].alias("confidence"))


@query
def geojson_features(spark, d):
    return _feature_fields(features.geojson_features(deduped(spark, d)), "feature")


@query
def poi_card(spark, d):
    return features.place_cards(frames.places(spark, d), "fresh")


@query
def tile_index(spark, d):
    return tiles.tile_index(frames.places(spark, d), 12).select("id", "z", "x", "y")


def _bucketed(spark, d):
    return deduped(spark, d).select("id", reports.category_bucket(F.col("category")).alias("cat"), "confidence", "lon", "lat")


@query
def tile_pyramid(spark, d):
    return tiles.tile_pyramid(_bucketed(spark, d))


@query
def tile_thinning(spark, d):
    return tiles.thin_tiles(_bucketed(spark, d), 10, [F.desc("confidence"), F.asc("id")]).select("z", "x", "y", "id", "tile_rank")


@query
def tile_drop_densest(spark, d):
    return thinning.drop_densest(_bucketed(spark, d), 10).select("z", "x", "y", "id")


# ---- files --------------------------------------------------------------------------------------
@query
def roundtrip_parquet(spark, d):
    path = scratch_path(spark, "layer")
    write_parquet(deduped(spark, d), path)
    return _joined_tags(scans.scan_places(spark, path))


@query
def clustered_window(spark, d):
    """Places in a window of a layer that was written along a space-filling curve."""
    path = scratch_path(spark, "clustered")
    write_clustered(frames.places(spark, d).select("id", "category", "lon", "lat"), path, F.col("lon"), F.col("lat"), group_rows=1000)
    return scans.scan_places(spark, path).where(F.col("lon").between(131.0, 132.5) & F.col("lat").between(33.5, 34.25))


@query
def roundtrip_csv(spark, d):
    path = scratch_path(spark, "register")
    write_register_csv(merged(spark, d), path)
    return spark.read.csv(path, header=True, escape='"').fillna("")


@query
def roundtrip_geojson(spark, d):
    path = scratch_path(spark, "features")
    write_geojson_lines(deduped(spark, d), path)
    return _feature_fields(spark.read.text(path), "value")


@query
def tsv_scan(spark, d):
    path = scratch_path(spark, "community")
    frames.community(spark, d).write.csv(path, sep="\t", header=True)
    return scans.scan_community_tsv(spark, path).withColumnsRenamed({"@lon": "lon_s", "@lat": "lat_s"})


@query
def tsv_typed(spark, d):
    path = scratch_path(spark, "community")
    frames.community(spark, d).write.csv(path, sep="\t", header=True)
    return scans.scan_community_tsv(spark, path, all_text=False).withColumnsRenamed({"@lon": "lon_s", "@lat": "lat_s"})


@query
def report_text(spark, d):
    counts = frames.places(spark, d).groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    share = F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(F.lit(0))), 1)
    return reports.with_display_text(counts.withColumn("pct", F.when(F.col("n") % 2 == 1, share)), ["n"], ["pct"])


@query
def region_edges_scan(spark, d):
    path = scratch_path(spark, "areas")
    feature = F.struct(
        F.lit("Feature").alias("type"), F.struct(F.col("pref").alias("nam_ja")).alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), F.col("rings").alias("coordinates")).alias("geometry"))
    frames.area_rings(spark, d).select(F.to_json(feature)).write.text(path)
    return scans.scan_region_edges(spark, path, lines=True).select(
        "pref", "ax", "ay", "bx", F.col("by").alias("by_"))
