"""The queries ``opN_<name>`` over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placemill.llm import alignment, balltree, bpe, chat, exact, html_text, imatch, langid, minhash, mixing, private, quality, repeats
from placemill.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def word_vocabulary() -> str:
    return vocabulary("word_bpe_49k.json")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "first")


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op3_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), imatch.shown(F.col("print")).alias("fingerprint"),
        imatch.shown(F.col("edited_print")).alias("edited_fingerprint"), "near_edited", "near_next")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded_digests(table(spark, sf_dir, "documents").select("doc_id", "text"), word_vocabulary())


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


# fixed values: the conversation added to the table
ADDED_ID, ADDED_TEXT = -7, "</s>[INST] ok [/INST]"


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(ADDED_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(chat.ASSISTANT).alias("role"), F.lit(ADDED_TEXT).alias("text"))
    back = chat.read_chats(chat.format_chats(rows.unionByName(added)))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


OP7_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT {ADDED_ID}, 0, 'user', '{ADDED_TEXT}' UNION ALL SELECT {ADDED_ID}, 1, 'assistant', '{ADDED_TEXT}'),
e AS (SELECT *, length(role) + length(text) + length(regexp_replace(role || text, '[^\\\\<|\\[]', '', 'g')) + 24 AS shown FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
  CAST(sum(shown) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


def op8_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.find_copies(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP8_SQL = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM t
"""


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.repetitions(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


_UNIT = "CAST(('0x' || substr(md5({}), 1, 12)) AS BIGINT) / 281474976710656.0"
OP10_SQL = f"""
WITH s AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
    CAST({_UNIT.format("coalesce(CAST(doc_id AS VARCHAR), 'null')")} AS DOUBLE) AS draw FROM documents),
t AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS documents FROM s GROUP BY source),
w AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM t),
c AS (SELECT *, (rank - 1) % 3 + 1 AS weight, source_size * 3 AS cap, CAST(source_size * 3 AS DOUBLE) / ((rank - 1) % 3 + 1) AS cap_level FROM w),
l AS (SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap_level, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
    / CAST(sum(weight) OVER (ORDER BY cap_level, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level FROM c),
f AS (SELECT arg_min(level, rank_of) AS level FROM (
    SELECT level, row_number() OVER (ORDER BY cap_level, rank) AS rank_of FROM l WHERE cap_level >= level)),
g AS (SELECT l.source, source_size, documents, CASE WHEN f.level IS NULL THEN cap ELSE least(cap, f.level * weight) END AS target FROM l, f),
r AS (SELECT s.doc_id, s.source, s.size, s.draw, g.source_size, CAST(g.target AS DOUBLE) AS target,
    CAST(floor(s.draw * ceil(g.documents / 1000.0)) AS BIGINT) AS block,
    CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0 END AS rate
  FROM s JOIN g ON s.source IS NOT DISTINCT FROM g.source),
u AS (SELECT *, row_number() OVER (PARTITION BY source, block ORDER BY size, draw, doc_id) * CAST(0.6180339887498949 AS DOUBLE)
    + CAST({_UNIT.format("coalesce(source, 'null') || '/' || CAST(block AS VARCHAR)")} AS DOUBLE) AS step FROM r)
SELECT doc_id, size, source_size, target,
  size * CAST(floor(rate) + CASE WHEN step - floor(step) < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS taken FROM u
"""

def op11_balltree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = """unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term"""
OP11_SQL = f"""
WITH t AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, {_TERMS} FROM documents) GROUP BY ALL),
d AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM t GROUP BY doc_id),
c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS len FROM d),
q AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, {_TERMS} FROM benchmark)),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * c.docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM t GROUP BY term), c),
s AS (SELECT q.item_id, t.doc_id, CAST(sum(w.w * ((1000000000 * t.tf) // (1000 * t.tf + 20 * (50 + (50 * d.n * c.docs) // c.len)))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN t USING (term) JOIN d USING (doc_id), c GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= {balltree.TOP}
"""

def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.agreement(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


def op13_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private.digests(private.find(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Query] = {
    "op1_minhash": op1_minhash,
    "op2_html": op2_html,
    "op3_fingerprint": op3_fingerprint,
    "op4_language": op4_language,
    "op5_bpe": op5_bpe,
    "op6_repeats": op6_repeats,
    "op7_chat": op7_chat,
    "op8_exact": op8_exact,
    "op9_quality": op9_quality,
    "op10_mixing": op10_mixing,
    "op11_balltree": op11_balltree,
    "op12_alignment": op12_alignment,
    "op13_private": op13_private,
}
ORACLES: dict[str, str] = {"op7_chat": OP7_SQL, "op8_exact": OP8_SQL, "op10_mixing": OP10_SQL, "op11_balltree": OP11_SQL}
