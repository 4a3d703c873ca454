"""Mixing sources to target weights, with DataFrame functions only.

Tokens are summed per source, targets are derived from weights, and each document is emitted floor(rate) times plus
one more copy with a probability equal to the fraction, drawn from a hash-seeded sequence.

Targets fill like water: sources share the total by weight, none beyond ``MAX_REPEATS`` times its own size, the excess
going to the others by weight. Sorted by cap per unit of weight, the level of the first source that does not reach
its cap is the level of all others; running sums over the table of sources (one row each) give it in one pass.

The draws of a source are spread evenly: in blocks of about ``BLOCK`` documents, picked by hash and ordered by size, the
numbers run through the golden-ratio sequence from a start that the block's hash seeds. Each number alone is
uniform, so every document keeps its probability, while a block's sum stays within about one document of its mean.

Defined results: a NULL or empty text has size 0; a NULL source is a source of its own, last in order; a source of size
0 has target 0; repeated rows are drawn one by one; an empty table gives an empty result; other columns are kept
by ``mix`` and ignored by ``repetitions``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placemill.llm.common import fresh, numbered, text_or_empty, unit_hash
from placemill.session import stable

# fixed values: what counts as a word, and the cycle of weights over the sources
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)

MAX_REPEATS = 3
BLOCK = 1000
GOLDEN = 0.6180339887498949


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_targets(totals: DataFrame) -> DataFrame:
    """(source, source_size, documents) with ``target``; one row per source."""
    everything = Window.partitionBy(F.lit(0))
    ranked = totals.withColumn("rank", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.col("rank") - 1) % len(WEIGHTS) + 1).cast("int"))
    weighed = ranked.withColumns({"weight": weight, "cap": F.col("source_size") * MAX_REPEATS}).withColumn(
        "cap_level", F.col("cap") / F.col("weight"))
    fill = everything.orderBy("cap_level", "rank")
    before = F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    level = (F.sum("source_size").over(everything) - before) / F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing))
    levels = weighed.withColumn("level", level)
    reached = F.when(F.col("cap_level") >= F.col("level"), F.struct("cap_level", "rank", "level"))
    final = F.min(reached).over(everything)["level"]
    target = F.least(F.col("cap").cast("double"), F.coalesce(final * F.col("weight"), F.col("cap").cast("double")))
    return levels.select("source", "source_size", "documents", target.alias("target"))


def repetitions(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, source, row, size, source_size, target, copies."""
    sizes = stable(docs.select(
        "doc_id", "source", F.monotonically_increasing_id().alias("row"), word_count(text_or_empty()).alias("size")), "sizes")
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents"))
    targets = source_targets(totals).withColumnRenamed("source", "_source")
    rows = sizes.join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")

    draw = unit_hash(F.col("doc_id"))
    block = F.floor(draw * F.ceil(F.col("documents") / BLOCK))
    within = Window.partitionBy("source", "block").orderBy("size", "draw", "doc_id")
    step = F.row_number().over(within) * GOLDEN + unit_hash(F.col("source"), F.col("block"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor("rate")
    return (
        rows.withColumns({"draw": draw, "block": block, "rate": rate})
        .withColumn("step", step)
        .withColumn("copies", whole + F.when(F.col("step") - F.floor("step") < F.col("rate") - whole, 1).otherwise(0))
        .select("doc_id", "source", "row", "size", "source_size", "target", "copies")
    )


def mix(docs: DataFrame) -> DataFrame:
    """The mixed documents: each row repeated as often as the mix takes it. ``docs`` must be a table scan."""
    number, copies, copy = (fresh(docs, name) for name in ("_row", "_copies", "_copy"))
    plan = repetitions(docs).where("copies > 0").select(F.col("row").alias(number), F.col("copies").cast("int").alias(copies))
    taken = numbered(docs, number).join(plan, number)
    return taken.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns)
