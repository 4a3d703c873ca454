"""I-Match document fingerprints, with DataFrame functions only.

Terms are lower-cased runs of letters and digits, hashed to ``SLOTS`` slots. A slot belongs to the lexicon if its inverse
document frequency ln(N / df) lies in a band. The lexicon is a bitmap of fixed size, so each text is filtered where it
lies, without a shuffle. Randomised subsets cut the lexicon: a document's distinct kept terms are sorted, and those of
each subset hashed together. The fingerprint is the list of these hashes; two fingerprints are as alike as the share
of their non-empty subsets that agree.

A subset must be small for its hash to survive an edit, and not so small that it misses short texts. A fingerprint
therefore uses lexicon cuts of two neighbouring densities, the denser one giving each subset about ``TERMS`` terms of
this document, and fingerprints are compared on the densities they share.

Defined results: a NULL text is the empty text; equal texts have equal fingerprints; a text without kept terms is
fingerprinted by all its terms; equal fingerprints are alike (1), also empty ones. Documents follow each other by
descending doc_id, NULL last, ties by a hash of the text; the last is followed by the first, and a single one by itself.
A row that occurs several times is followed by its own copies. An empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placemill.llm.common import text_or_empty

IDF_BAND = (1.2, 6.9)  # natural logarithms: terms in 30 % to 0.1 % of the documents
SLOTS = 1 << 20
SUBSETS = 32           # subsets hashed per density
BLOCKS_PER_PARTITION = 2
TERMS = 1.0            # terms of a document that a subset of the denser cut should hold


def let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with the value computed once per row: inside lambda functions an expression that is named twice, or named
    in an inner lambda, would be computed again each time."""
    return F.transform(F.array(value), fn)[0]


def terms_of(text: Column) -> Column:
    """Distinct terms of a text as slots, in order."""
    words = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    slots = F.transform(words, lambda w: F.when(w != "", F.pmod(F.xxhash64(w), F.lit(SLOTS)).cast("int")))
    return F.array_sort(F.array_compact(F.array_distinct(slots)))


def lexicon(docs: DataFrame, band: tuple[float, float] = IDF_BAND) -> Column:
    """The slots whose inverse document frequency lies in the band, as a constant bitmap of SLOTS / 64 numbers."""
    n, (lowest, highest) = docs.count(), band
    df = docs.select(F.explode(terms_of(text_or_empty())).alias("slot")).groupBy("slot").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(F.lit(float(max(n, 1))) / F.col("df"))
    bit = F.expr("shiftleft(1L, slot % 64)")
    words = df.where((idf >= lowest) & (idf <= highest)).groupBy(F.expr("slot div 64").alias("word")).agg(F.bit_or(bit).alias("bits"))
    found = {r["word"]: r["bits"] for r in words.collect()}  # SLOTS / 64 rows at most
    return F.split(F.lit(",".join(str(found.get(i, 0)) for i in range(SLOTS // 64))), ",").cast("array<long>")


def kept_terms(terms: Column, bitmap: Column) -> Column:
    """The terms in the lexicon, or all if there are none."""
    inside = lambda all_: F.filter(all_, lambda t: F.getbit(F.get(bitmap, F.shiftright(t, 6)), F.pmod(t, F.lit(64))) == 1)
    return let(terms, lambda all_: let(inside(all_), lambda kept: F.when(F.size(kept) > 0, kept).otherwise(all_)))


def fingerprint(terms: Column) -> Column:
    """The hashes of the non-empty subsets as numbers: density above bit 38, subset above bit 32, hash below."""
    def dense(all_: Column) -> Column:
        return F.greatest(F.lit(0), F.round(F.log2(F.greatest(F.size(all_), F.lit(1)) / (SUBSETS * TERMS))).cast("int"))

    def one(mine: Column, level: Column, s: Column) -> Column:
        own = F.transform(F.filter(mine, lambda x: x["s"] == s), lambda x: x["t"])
        prefix = level.cast("long") * (1 << 38) + s.cast("long") * (1 << 32)
        return let(own, lambda o: F.when(F.size(o) > 0, prefix + F.pmod(F.xxhash64(o), F.lit(1 << 32))))

    def cut(all_: Column, level: Column) -> Column:
        def placed(subsets: Column) -> Column:
            every = F.transform(all_, lambda t: F.struct(F.pmod(F.xxhash64(t), subsets).alias("s"), t.alias("t")))
            return F.filter(every, lambda x: x["s"] < SUBSETS)

        mine = let(F.lit(SUBSETS) * F.pow(F.lit(2), level).cast("int"), placed)
        numbers = F.array(*map(F.lit, range(SUBSETS)))
        return let(mine, lambda m: F.array_compact(F.transform(numbers, lambda s: one(m, level, s))))

    return let(terms, lambda all_: let(dense(all_), lambda d: F.concat(cut(all_, d), cut(all_, d + 1))))


def likeness(a: Column, b: Column) -> Column:
    """Share of agreeing subsets over the densities that both fingerprints use."""
    level = lambda x: F.shiftright(x, 38)
    subset = lambda x: F.shiftright(x, 32)

    def share(shared: Column) -> Column:
        either = F.array_union(F.transform(a, subset), F.transform(b, subset))
        subsets = F.size(F.filter(either, lambda s: F.array_contains(shared, F.shiftright(s, 6))))
        return F.size(F.array_intersect(a, b)) / F.greatest(subsets, F.lit(1))

    shared = F.array_intersect(F.transform(a, level), F.transform(b, level))
    return F.when(a == b, 1.0).otherwise(let(shared, share).cast("double"))


def shown(prints: Column) -> Column:
    return F.array_join(F.transform(prints, lambda x: F.lower(F.hex(x))), ".")


def with_follower(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """``rows`` (key, hash, ...) with ``columns`` of the row that follows in descending order, as struct ``next``.

    The first rows of a few ranges per shuffle partition cut the order into blocks. Each row is sent to its
    block, the first row of a block also to the block before, so the rows move once."""
    blocks = BLOCKS_PER_PARTITION * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = rows.select("key", "hash").repartitionByRange(blocks, F.col("key").desc(), F.col("hash").desc())
    firsts = keys.groupBy(F.spark_partition_id()).agg(F.max(F.struct("key", "hash")).alias("first")).select("first.*").collect()
    starts = sorted(firsts, reverse=True)  # one per range
    listed = F.array(*[F.struct(F.lit(k).cast("long").alias("key"), F.lit(h).cast("long").alias("hash")) for k, h in starts])
    if not starts:
        return rows.withColumn("next", F.struct(*columns)).where("false")
    before = F.filter(listed, lambda s: (s["key"] > F.col("key")) | ((s["key"] == F.col("key")) & (s["hash"] >= F.col("hash"))))
    is_first = F.exists(listed, lambda s: (s["key"] == F.col("key")) & (s["hash"] == F.col("hash")))
    place = lambda block, extra: F.struct(block.cast("int").alias("block"), F.lit(extra).alias("extra"))
    placed = rows.withColumn("block", F.size(before) - 1).withColumn("is_first", is_first)
    previous = (F.col("block") + len(starts) - 1) % len(starts)
    places = F.when(F.col("is_first"), F.array(place(F.col("block"), False), place(previous, True))).otherwise(
        F.array(place(F.col("block"), False)))
    sent = placed.withColumn("place", F.explode(places)).drop("block", "is_first")
    order = Window.partitionBy("place.block").orderBy("place.extra", F.col("key").desc(), F.col("hash").desc())
    return sent.withColumn("next", F.lead(F.struct(*columns)).over(order)).where("NOT place.extra").drop("place")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited (the edited text), print, edited_print, near_edited, near_next for every document."""
    bitmap = lexicon(docs)
    rows = docs.select("doc_id", text_or_empty().alias("text")).withColumns({
        "key": F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))), "hash": F.xxhash64("text")})
    printed = rows.withColumn("print", fingerprint(kept_terms(terms_of(F.col("text")), bitmap)))
    followed = with_follower(printed, ("text", "print"))
    n, third = F.char_length("text"), F.expr("cast(char_length(text) div 3 as int)")
    edited = F.concat(F.substring("text", F.lit(1), n - third), F.substring(F.col("next.text"), F.lit(1), third))
    done = followed.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "print", F.col("next.print").alias("next_print")).withColumn(
        "edited_print", fingerprint(kept_terms(terms_of(F.col("edited")), bitmap)))
    return done.withColumns({"near_edited": likeness(F.col("print"), F.col("edited_print")),
                             "near_next": likeness(F.col("print"), F.col("next_print"))})
