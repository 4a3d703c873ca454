"""Provider rules: best single provider per chain, and who supplied what."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placemill import vocab
from placemill.functions.classify import chain_of
from placemill.sources.inline import TEXT, inline_relation


def food_places(places: DataFrame, country: str = vocab.HOME_COUNTRY,
                excluded: Sequence[str] = vocab.NON_FOOD_CATEGORIES) -> DataFrame:
    """Places of one country without the excluded categories; NULL country or category drops."""
    return places.where((F.col("country") == country) & ~F.col("category").isin(*excluded))


def chain_provider_table(spark, mapping=vocab.CHAIN_PROVIDER) -> DataFrame:
    """The inline chain-to-provider relation."""
    return inline_relation(spark, {"chain": TEXT, "provider": TEXT}, mapping)


def keep_best_provider(places: DataFrame, best: DataFrame | None = None) -> DataFrame:
    """Keep a chain's records from its one chosen provider, and everything that is no chain.

    The inline mapping has one row per chain of the fixed list, so its broadcast cannot grow with the data.
    A caller's own ``best`` table gets no hint: the optimizer then decides by its size.
    """
    if best is None:
        best = F.broadcast(chain_provider_table(places.sparkSession))
    tagged = food_places(places).withColumn("chain", chain_of(F.col("name")))
    is_chain = F.col("chain").isNotNull()
    return (
        tagged.join(best, "chain", "left")
        .where(~is_chain | F.array_contains("datasets", F.col("provider")))
        .withColumn("dedup_method", F.when(is_chain, "best-provider").otherwise("as-is"))
        .select(*[c for c in places.columns if c != "datasets"], "chain", "dedup_method")
    )


def providers_of(places: DataFrame, umbrella: str = vocab.UMBRELLA_DATASET) -> DataFrame:
    """One row per record and distinct contributing provider, the umbrella tag left out."""
    provider = F.explode(F.array_distinct("datasets"))
    return places.withColumn("provider", provider).where(F.col("provider") != umbrella)


def best_provider_by_chain(places: DataFrame) -> DataFrame:
    """The provider with the most records for each chain; ties go to the later name."""
    counts = (
        providers_of(places.select("datasets", chain_of(F.col("name")).alias("chain"))
                     .where(F.col("chain").isNotNull()))
        .groupBy("chain", "provider").agg(F.count(F.lit(1)).alias("n"))
    )
    best = F.max(F.struct("n", "provider"))
    return counts.groupBy("chain").agg(best.alias("b")).select("chain", "b.provider", "b.n")


def provider_composition(places: DataFrame, country: str = vocab.HOME_COUNTRY) -> DataFrame:
    """Records and share per provider. The share is over provider mentions."""
    counts = (
        providers_of(places.where(F.col("country") == country).select("datasets"))
        .groupBy("provider").agg(F.count(F.lit(1)).alias("n"))
    )
    total = F.sum("n").over(Window.partitionBy())  # over the few counted providers, not over records
    return counts.select("provider", "n", F.round(F.col("n") / total * 100, 4).alias("share_pct"))


def country_composition(places: DataFrame) -> DataFrame:
    return places.groupBy("country").agg(F.count(F.lit(1)).alias("n"))
