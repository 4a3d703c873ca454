"""Reports over the place, community and master tables; each returns a small relation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemill import vocab
from placemill.functions.classify import category_bucket, label_of, shop_bucket
from placemill.functions.geo import Degrees, Metres, parse_degrees
from placemill.operators.proximity import without_neighbour
from placemill.sources.inline import NUMBER, TEXT, inline_relation


def report_spine(spark, buckets=vocab.BUCKETS) -> DataFrame:
    """The fixed list of buckets in display order: (ord, bucket, label)."""
    return inline_relation(
        spark, {"ord": NUMBER, "bucket": TEXT, "label": TEXT}, [(i, *pair) for i, pair in enumerate(buckets, 1)])


def _count_by(rows: DataFrame, key, name: str) -> DataFrame:
    return rows.select(key.alias("bucket")).where(F.col("bucket").isNotNull()).groupBy("bucket").agg(
        F.count(F.lit(1)).alias(name))


def compare_sources(deduped: DataFrame, tagged: DataFrame) -> DataFrame:
    """Shops per bucket in the two sources and the difference, in display order; a missing bucket counts 0.

    The joined relations have at most one row per bucket.
    """
    primary = _count_by(deduped, category_bucket(F.col("category")), "primary_n")
    secondary = _count_by(tagged, shop_bucket(F.col("shop"), F.col("amenity")), "secondary_n")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return (
        report_spine(deduped.sparkSession)
        .join(primary, "bucket", "left").join(secondary, "bucket", "left")
        .select("ord", "bucket", "label", zero("primary_n").alias("primary_n"), zero("secondary_n").alias("secondary_n"))
        .withColumn("diff", F.col("primary_n") - F.col("secondary_n"))
        .orderBy("ord")
    )


def compare_with_total(comparison: DataFrame) -> DataFrame:
    """The comparison plus a line for all buckets together."""
    sums = [F.sum(c).alias(c) for c in ("primary_n", "secondary_n", "diff")]
    return comparison.rollup("bucket").agg(*sums).withColumn("bucket", F.coalesce("bucket", F.lit("all")))


def coverage_ratio(comparison: DataFrame, official: Sequence[tuple[str, int]] = vocab.OFFICIAL_COUNTS) -> DataFrame:
    """Counts of both sources as a percentage of the official number of stores."""
    reference = inline_relation(comparison.sparkSession, {"bucket": TEXT, "official": NUMBER}, official)
    pct = lambda c: F.round(F.col(c) / F.col("official") * 100, 4)
    return comparison.join(reference, "bucket").select(
        "bucket", "official", "primary_n", "secondary_n",
        pct("primary_n").alias("primary_pct"), pct("secondary_n").alias("secondary_pct"),
    )


def union_inflation(places: DataFrame, tagged: DataFrame, official: int,
                    near: Degrees | Metres = Degrees(vocab.DUPLICATE_DEGREES)) -> DataFrame:
    """Size of the proximity-matched union of both sources' convenience stores against the official count."""
    main = places.where(F.col("category") == "convenience_store").select("lon", "lat")
    extra = tagged.where(F.lower("shop") == "convenience").select(
        parse_degrees(F.col("`@lon`")).alias("lon"), parse_degrees(F.col("`@lat`")).alias("lat"))
    unmatched = without_neighbour(extra, main, near)
    sides = main.select(F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(
        unmatched.select(F.lit(0).alias("a"), F.lit(1).alias("b")))
    return sides.agg(
        F.coalesce(F.sum("a"), F.lit(0)).alias("n_primary"), F.coalesce(F.sum("b"), F.lit(0)).alias("n_added")
    ).select(
        "n_primary", "n_added", (F.col("n_primary") + F.col("n_added")).alias("n_union"),
        F.round((F.col("n_primary") + F.col("n_added")) / F.lit(official) * 100, 4).alias("union_pct"),
    )


def master_counts(master: DataFrame) -> DataFrame:
    """Stores per category with its display label, most frequent first."""
    return (
        master.groupBy("cat").agg(F.count(F.lit(1)).alias("n"))
        .select("cat", label_of(F.col("cat"), vocab.MASTER_LABELS, vocab.OTHER_LABEL).alias("label"), "n")
        .orderBy(F.desc("n"), "cat")
    )


def row_accounting(tallied: DataFrame) -> DataFrame:
    """Candidates, rows in a region (a candidate in two counts twice), and the difference, from one pass of tallied rows."""
    sums = tallied.agg(F.count_if(~F.col("hit")).alias("n_candidates"), F.count_if("hit").alias("n_master"))
    return sums.withColumn("n_dropped", F.col("n_candidates") - F.col("n_master"))


def with_display_text(report: DataFrame, counts: Sequence[str] = (), percents: Sequence[str] = ()) -> DataFrame:
    """Counts with thousands separators and percentages to one decimal, as text for a printed table."""
    text = {c: F.format_number(c, 0) for c in counts}
    text.update({c: F.when(F.col(c).isNull(), "―").otherwise(F.format_string("%.1f%%", c)) for c in percents})
    return report.withColumns(text)
