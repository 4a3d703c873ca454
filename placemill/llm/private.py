"""Personal data by bootstrapped contextual extraction, with DataFrame and SQL functions only.

* Seeds are what the fixed patterns of e-mail addresses, IP addresses, card and phone numbers match and their checks accept.
* A lexical pattern is the two words (runs of letters, lower-cased) before an identifier. It is induced by at least ``SUPPORT``
  different seeds of one kind.
* Candidates are further strings that look like an identifier of some kind and overlap no seed: addresses with letters beyond
  ASCII or without a dot, numbers of seven digits or more in any notation.
* Patterns and instances form a graph, weighed by occurrences. In each of ``ROUNDS`` rounds a pattern's confidence is the sum
  of its instances' scores over all occurrences of its two words in the corpus, whatever follows them; a candidate's score is the
  chance that not all confident patterns before it are wrong. Seeds keep the score 1. So a pattern of common words, which
  rarely precede an identifier, finds nothing, and candidates that are accepted strengthen the other patterns they occur with.
* Candidates of at least ``LEAST`` are added wherever they occur.

A text is matched where it lies: matches and the gaps between them are exploded, and a running sum per text gives positions in
code points. Spans, not texts, are shuffled. Occurrences of patterns are counted in a second pass, in which a bitmap of fixed
size keeps all other pairs of words from being exploded.

The patterns are written so that matching is linear in the text: what follows never begins with a character of the run before,
so runs are possessive; and a match can only begin where a run begins or where the last match has ended.

Defined results: a NULL text is the empty text; rows are treated one by one, repeated ones alike; a text without spans has empty
spans; NULL doc_ids are kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placemill.llm.common import text_or_empty
from placemill.session import stable

KINDS = ("email", "ip", "card", "phone")

# the base patterns, each the given one in linear form
_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",  # shorter runs of digits can't pass
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_WIDE = r"\p{L}\p{N}._%+-"
OTHER = (rf"(?:(?<![{_WIDE}])|\G)[{_WIDE}]++@[\p{{L}}\p{{N}}-]++(?:\.[\p{{L}}\p{{N}}-]++)*+"
         r"|\(?[0-9](?:[\x20().:/-]{0,2}+[0-9]){6,}+")

WORD = r"[\p{L}\p{M}]+"
GAP = 80           # characters before a match that are searched for its two words
LONGEST_WORD = 30
SUPPORT = 3        # different seeds that induce a pattern
LEAST = 0.6        # of a pattern's confidence and of a candidate's score
ROUNDS = 3
SLOTS = 1 << 20    # bits of the pattern bitmap


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _accepted(kind: Column, value: Column) -> Column:
    digits = F.length(_digits(value))
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"))
        .when(kind == "card", digits.between(12, 19) & F.expr("luhn_check(regexp_replace(value, '[^0-9]', ''))"))
        .when(kind == "phone", digits.between(9, 15)).otherwise(False))


def _matches(text: Column, kind: str, pattern: str, possible: Column) -> Column:
    """Of each match in order: its kind, text and length, the length of the gap before it, and that gap's end."""
    gap_end = lambda gap: F.when(F.char_length(gap) <= GAP, gap).otherwise(F.regexp_replace(F.substring(gap, -GAP, GAP), f"^{WORD}", ""))
    row = lambda gap, hit: F.when(hit.isNotNull(), F.struct(
        F.lit(kind).alias("kind"), hit.alias("value"), F.char_length(hit).alias("size"), F.char_length(gap).alias("gap"), gap_end(gap).alias("before")))
    found = F.array_compact(F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), row))
    return F.when(possible, found).otherwise(F.array().cast(_MATCHES))


_MATCHES = "array<struct<kind: string, value: string, size: int, gap: int, before: string>>"


def occurrences(marked: DataFrame) -> DataFrame:
    """(row, kind, value, before, start, end, seed): spans in code points. ``kind`` is 'other' for candidates."""
    each = marked.select("row", F.posexplode("found").alias("at", "m")).select("row", "at", "m.*")
    end = F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy("row", "kind").orderBy("at"))
    placed = each.withColumn("end", end).withColumn("start", F.col("end") - F.col("size"))
    placed = placed.withColumn("seed", _accepted(F.col("kind"), F.col("value"))).where("seed OR kind = 'other'")
    # both are running values: from the first start up to this one, and from the last down to it
    upward, downward = (Window.partitionBy("row").orderBy(o).rangeBetween(Window.unboundedPreceding, 0) for o in (F.col("start"), F.col("start").desc()))
    before = F.max(F.when(F.col("seed"), F.col("end"))).over(upward)
    after = F.min(F.when(F.col("seed"), F.col("start"))).over(downward)
    free = ~(F.coalesce(before > F.col("start"), F.lit(False)) | F.coalesce(after < F.col("end"), F.lit(False)))
    return placed.withColumn("free", free).where("seed OR free").select("row", "kind", "value", "before", "start", "end", "seed")


def marks(docs: DataFrame) -> DataFrame:
    """(row, doc_id, found): all matches of the base patterns and candidates of each text."""
    text = F.col("text")
    number = text.rlike(r"[0-9](?:[\x20().:/-]{0,2}+[0-9]){6,}+")
    found = F.concat(
        _matches(text, "email", BASE["email"], text.contains("@")), _matches(text, "ip", BASE["ip"], text.rlike(r"[0-9]\.[0-9]")),
        _matches(text, "card", BASE["card"], number), _matches(text, "phone", BASE["phone"], text.contains("+")),
        _matches(text, "other", OTHER, number | text.contains("@")))
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), text_or_empty().alias("text")).select(
        "row", "doc_id", found.alias("found"))


# ---- patterns and instances ------------------------------------------------------------------------------
def _last_words(before: Column) -> Column:
    words = F.regexp_extract_all(F.lower(before), F.lit(WORD), F.lit(0))
    fits = (F.size(words) >= 2) & (F.length(F.get(words, F.size(words) - 1)) <= LONGEST_WORD) & (F.length(F.get(words, F.size(words) - 2)) <= LONGEST_WORD)
    return F.when(fits, F.slice(words, -2, 2))


def graph(spans: DataFrame) -> DataFrame:
    """(kind, first, second, pattern, instance, seed, times): which patterns occur how often with which instances. A candidate may be
    of several kinds."""
    value, digits = F.col("value"), F.length(_digits(F.col("value")))
    kinds = F.when(F.col("seed"), F.array("kind")).otherwise(F.array_compact(F.array(
        F.when(value.contains("@"), "email"), F.when(value.rlike(r"^[0-9]+(?:[.:][0-9]+){3,}$"), "ip"),
        F.when(~value.contains("@") & digits.between(12, 19), "card"), F.when(~value.contains("@") & digits.between(7, 15), "phone"))))
    each = spans.select("row", "start", "end", "seed", _last_words(F.col("before")).alias("words"), F.explode(kinds).alias("kind"), "value")
    return each.select(
        "row", "start", "end", "seed", "kind", F.col("words")[0].alias("first"), F.col("words")[1].alias("second"),
        F.when(F.col("kind") == "email", F.lower("value")).when(F.col("kind") == "ip", F.col("value")).otherwise(_digits(F.col("value"))).alias("instance"))


def word_pairs(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """(first, second, n): how often the words of each pattern follow each other in the whole corpus."""
    slots = patterns.select(F.pmod(F.xxhash64("first", "second"), F.lit(SLOTS)).cast("int").alias("slot"))
    bits = slots.groupBy(F.expr("slot div 64").cast("int").alias("word")).agg(F.expr("bit_or(shiftleft(1L, slot % 64))").alias("bits"))
    found = {r["word"]: r["bits"] for r in bits.collect()}  # SLOTS / 64 rows at most
    bitmap = F.split(F.lit(",".join(str(found.get(i, 0)) for i in range(SLOTS // 64))), ",").cast("array<long>")
    words = docs.select(F.split(F.lower(text_or_empty()), rf"[^\p{{L}}\p{{M}}]+").alias("words")).where(F.size("words") >= 2)
    pairs = F.zip_with(F.slice("words", F.lit(1), F.size("words") - 1), F.slice("words", F.lit(2), F.size("words") - 1),
                       lambda a, b: F.struct(a.alias("first"), b.alias("second"), F.pmod(F.xxhash64(a, b), F.lit(SLOTS)).cast("int").alias("slot")))
    likely = F.filter(pairs, lambda p: F.getbit(F.get(bitmap, (p["slot"] / 64).cast("int")), p["slot"] % 64) == 1)
    counted = words.select(F.inline(likely)).groupBy("first", "second").agg(F.count(F.lit(1)).alias("n"))
    return counted.join(patterns.select("first", "second").distinct(), ["first", "second"], "left_semi")


def discovered(docs: DataFrame, mentions: DataFrame) -> tuple[DataFrame | None, DataFrame | None]:
    """((kind, instance, score) of the accepted candidates, (kind, first, second, confidence) of the confident patterns); None
    if no pattern has enough seeds."""
    edges = stable(mentions.where("first IS NOT NULL").groupBy("kind", "first", "second", "instance").agg(
        F.count(F.lit(1)).alias("times"), F.max("seed").alias("seed")), "edges")
    induced = edges.where("seed").groupBy("kind", "first", "second").agg(F.count(F.lit(1)).alias("support")).where(F.col("support") >= SUPPORT)
    # a pattern that no candidate follows has nothing to find
    induced = stable(induced.join(edges.where("NOT seed").select("kind", "first", "second").distinct(), ["kind", "first", "second"], "left_semi"), "induced")
    if induced.isEmpty():
        return None, None
    totals = stable(word_pairs(docs, induced), "word-pairs")
    edges = edges.join(induced.select("kind", "first", "second"), ["kind", "first", "second"])
    edges = stable(edges.join(totals, ["first", "second"], "left"), "induced-edges")
    scores = patterns = None
    for _ in range(ROUNDS):
        scored = edges.withColumn("score", F.when(F.col("seed"), 1.0).otherwise(0.0))
        if scores is not None:
            scored = edges.join(scores, ["kind", "instance"], "left").withColumn(
                "score", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("score", F.lit(0.0))))
        times = F.greatest(F.coalesce(F.max("n"), F.lit(0)), F.sum("times"))
        confident = scored.groupBy("kind", "first", "second").agg((F.sum(F.col("times") * F.col("score")) / times).alias("confidence"))
        patterns = stable(confident.where(F.col("confidence") >= LEAST), "patterns")
        # 1e-9: a pattern may be certain
        doubt = F.sum(F.log(F.lit(1 + 1e-9) - F.least("confidence", F.lit(1.0))))
        found = edges.where("NOT seed").join(patterns, ["kind", "first", "second"]).groupBy("kind", "instance").agg((1 - F.exp(doubt)).alias("score"))
        scores = stable(found.where(F.col("score") >= LEAST), "scores")
    return scores, patterns


# ---- spans -----------------------------------------------------------------------------------------------
def _told(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, base, added): of each text the spans (start, rank, end, kind) by the base patterns and those that the method adds."""
    marked = stable(marks(docs), "marks")
    spans = stable(occurrences(marked), "occurrences")
    mentions = stable(graph(spans), "mentions")
    scores, _ = discovered(docs, mentions)
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int").alias("rank")
    span = F.struct(F.col("start"), rank, F.col("end"), F.col("kind"))
    rows = spans.where("seed").select("row", F.lit(True).alias("base"), span.alias("span"))
    if scores is not None:
        kept = mentions.where("NOT seed").join(scores, ["kind", "instance"])
        one = kept.groupBy("row", "start", "end").agg(F.max_by("kind", F.struct("score", -rank)).alias("kind"))
        rows = rows.union(one.select("row", F.lit(False), span))
    of = lambda base: F.array_sort(F.collect_list(F.when(F.col("base") if base else ~F.col("base"), F.col("span"))))
    grouped = rows.groupBy("row").agg(of(True).alias("base"), of(False).alias("added"))
    none = F.array().cast("array<struct<start: bigint, rank: int, end: bigint, kind: string>>")
    joined = marked.select("row", "doc_id").join(grouped, "row", "left")
    return joined.select("doc_id", F.coalesce("base", none).alias("base"), F.coalesce("added", none).alias("added"))


def digests(found: DataFrame) -> DataFrame:
    """Per document: how many base spans of each kind, their digest, all spans as text, and how many the method added."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    everything = F.array_sort(F.concat("base", "added"))
    return found.select("doc_id", *map(count, KINDS), F.sha2(_told(F.col("base")), 256).alias("base_sha256"), _told(everything).alias("spans"),
                        F.size("added").cast("long").alias("n_added"))
