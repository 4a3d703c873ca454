"""Small document tables with every awkward case."""

import random

CLASHING = ["row", "key", "hash", "ids", "score", "lang_pred", "digest", "copies", "node", "root", "_row", "_text", "held_out", "part"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)

_rng = random.Random(7)
VOCABULARY = ["".join(_rng.choice("abcdefghilmnorstuv") for _ in range(_rng.randint(2, 8))) for _ in range(3000)]


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def edited(text, seed, changes=1):
    rng, words = random.Random(seed), text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = rng.choice(VOCABULARY) + "x"
    return " ".join(words)


def awkward():
    """(doc_id, text, lang, source) with nulls, empty and very long texts, ties and repeated rows."""
    base, long = prose(120, 1), prose(20_000, 2)
    return [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, base.upper(), "en", "a"), (4, edited(base, 5), "en", "b"),
        (5, None, "en", "b"), (6, "", None, None), (7, " \n\t ", "de", "b"), (8, long, "en", "c"), (9, edited(long, 6, 30), "en", "c"),
        (10, "one", "de", None), (10, "one", "de", None), (11, "one", "de", ""), (None, base, "en", "a"), (None, None, None, None),
        (12, "éÉ ÀÑ É", "fr", "d"), (13, "!!! 123 ???", "fr", "d"), (14, "a" * 70_000, "fr", "d"),
        (-5, prose(90, 3), "en", "e"), (15, "line\nline\nline", "en", "e"), (16, prose(3, 4), "en", "a"),
    ]


def table(spark, rows):
    full = [(d, t, lang, source, None if t is None else len(t), *["x"] * len(CLASHING)) for d, t, lang, source in rows]
    return spark.createDataFrame(full, SCHEMA)


def stored(spark, rows, folder):
    """The rows as a parquet table, for operators that scan their input twice."""
    path = str(folder / "documents.parquet")
    table(spark, rows).repartition(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
