"""Classification expressions: chains, branch names, buckets, labels, noise."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from placemill import vocab


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def first_match(rules: Sequence[tuple[str, Column]]) -> Column:
    """CASE over (label, condition) in order; NULL when nothing holds."""
    label, condition = rules[0]
    case = F.when(condition, F.lit(label))
    for label, condition in rules[1:]:
        case = case.when(condition, F.lit(label))
    return case


def chain_of(name: Column, patterns=vocab.CHAIN_PATTERNS) -> Column:
    """Chain of a shop name, or NULL. The category plays no part."""
    return first_match([(chain, _any([name.like(p) for p in likes])) for chain, likes in patterns])


def chain_or_other(name: Column, patterns=vocab.CHAIN_PATTERNS, other: str = vocab.OTHER_CHAIN) -> Column:
    return F.coalesce(chain_of(name, patterns), F.lit(other))


def is_branded(name: Column, suffix: str = vocab.BRANCH_SUFFIX) -> Column:
    """Name carries a branch suffix; NULL for a NULL name."""
    return name.like(suffix)


def category_bucket(category: Column, mapping=vocab.CATEGORY_BUCKET, other: str = "fresh") -> Column:
    """Comparison bucket of a place category; unknown and NULL go to ``other``."""
    return first_match([(bucket, category == value) for value, bucket in mapping]).otherwise(other)


def shop_bucket(shop: Column, amenity: Column) -> Column:
    """Comparison bucket of community tags, ignoring case; NULL when not a food shop."""
    shop, amenity = F.lower(shop), F.lower(amenity)
    rules = [(bucket, shop.isin(*tags)) for bucket, tags in vocab.SHOP_BUCKET]
    bucket, condition = rules[-1]
    rules[-1] = (bucket, condition | (amenity == vocab.FRESH_AMENITY))
    return first_match(rules)


def label_of(key: Column, labels: Sequence[tuple[str, str]], other: str | None = None) -> Column:
    """Display label; NULL, '' and unknown keys give ``other``."""
    return first_match([(label, key == value) for value, label in labels]).otherwise(other)


def is_noise(name: Column, tags: Column) -> Column:
    """Food-service or general-goods record among groceries.

    Stays three-valued: a NULL name yields TRUE or NULL, so a filter on its negation drops the row.
    """
    def shares(values):
        return F.size(F.array_intersect(tags, F.array(*[F.lit(v) for v in values]))) > 0

    by_tag = tags.isNotNull() & shares(vocab.NOISE_TAGS) & ~shares(vocab.FOOD_TAGS)
    return by_tag | _any([name.ilike(p) for p in vocab.NOISE_NAME_PATTERNS])
