r"""Chat formatting with DataFrame functions only.

Layouts of conversations differ from one data set to the next. The nested field paths of a frame's schema are hashed
to a fingerprint, which selects a declarative mapping from the layout to canonical turns (conv_id, turn, role, text).
A registry (:data:`LAYOUTS`) holds the mappings; new layouts are added as data.

Turns are rendered as ``<|im_start|>role\ntext<|im_end|>\n``. Inside roles and texts the characters that control
strings are made of are written as backslash codes, so no control string of this or another template survives in a
text, and reading back is exact. A loss mask marks the assistant texts as spans of code points.

Defined results: turns are ordered by turn, NULL first, ties by role and text; a NULL text or role is empty; rows
with a NULL conv_id form one conversation; repeated rows are repeated turns; an empty table gives no
conversation; columns that a mapping does not name are ignored. A conversation is one output row, so its turns
meet in one task; different conversations never do.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: the marks of the template
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
ASSISTANT = "assistant"


# ---- layouts ---------------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Layout:
    """How canonical turns follow from one layout.

    ``paths``: the field paths that make the layout. ``rows``: (turn, role, text) columns when each row is one turn.
    ``messages``: (array, role field, text field). ``parts``: (role, column) pairs of one-row conversations, in order.
    ``roles``: names of roles in this layout and the canonical ones.
    """

    name: str
    paths: tuple[str, ...]
    key: str
    rows: tuple[str, str, str] | None = None
    messages: tuple[str, str, str] | None = None
    parts: tuple[tuple[str, str], ...] = ()
    roles: tuple[tuple[str, str], ...] = ()


LAYOUTS = (
    Layout("turn rows", ("conv_id", "role", "text", "turn"), "conv_id", rows=("turn", "role", "text")),
    Layout("messages", ("conv_id", "messages[].content", "messages[].role"), "conv_id", messages=("messages", "role", "content")),
    Layout("from and value", ("conversations[].from", "conversations[].value", "id"), "id",
           messages=("conversations", "from", "value"), roles=(("human", "user"), ("gpt", ASSISTANT))),
    Layout("prompt and response", ("id", "prompt", "response"), "id", parts=(("user", "prompt"), (ASSISTANT, "response"))),
    Layout("instruction", ("id", "input", "instruction", "output"), "id",
           parts=(("system", "instruction"), ("user", "input"), (ASSISTANT, "output"))),
)


def field_paths(kind: T.DataType, prefix: str = "") -> list[str]:
    """The leaves of a schema: names joined by dots, ``[]`` for arrays."""
    if isinstance(kind, T.StructType):
        dot = f"{prefix}." if prefix else ""
        return [p for f in kind.fields for p in field_paths(f.dataType, dot + f.name)]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{prefix}[]")
    return [prefix]


def fingerprint(paths: list[str] | tuple[str, ...]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def choose_layout(df: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> Layout:
    """The layout with the frame's fingerprint, or else the one with most paths among those the frame contains."""
    paths = field_paths(df.schema)
    by_print = {fingerprint(x.paths): x for x in layouts}
    if found := by_print.get(fingerprint(paths)):
        return found
    inside = [x for x in layouts if set(x.paths) <= set(paths)]
    if not inside:
        raise ValueError(f"no layout for the fields {sorted(paths)}")
    return max(inside, key=lambda x: len(x.paths))


def canonical_turns(df: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(conv_id, turns array<struct<turn, role, text>>), one row per conversation."""
    layout = choose_layout(df, layouts)
    empty = lambda c: F.coalesce(c.cast("string"), F.lit(""))

    def role_of(role: Column) -> Column:
        named = empty(role)
        for name, canonical in layout.roles:
            named = F.when(named == name, F.lit(canonical)).otherwise(named)
        return named

    turn = lambda n, role, text: F.struct(n.cast("long").alias("turn"), role_of(role).alias("role"), empty(text).alias("text"))
    key = F.col(layout.key).alias("conv_id")
    if layout.rows:
        n, role, text = map(F.col, layout.rows)
        return df.select(key, turn(n, role, text).alias("t")).groupBy("conv_id").agg(
            F.array_sort(F.collect_list("t")).alias("turns"))
    if layout.messages:
        array, role, text = layout.messages
        turns = F.transform(F.coalesce(F.col(array), F.array()), lambda m, i: turn(i, m[role], m[text]))
    else:
        turns = F.filter(F.array(*[
            F.when(F.col(column).isNotNull(), turn(F.lit(i), F.lit(role), F.col(column)))
            for i, (role, column) in enumerate(layout.parts)]), lambda t: t.isNotNull())
    return df.select(key, turns.alias("turns"))


# ---- template --------------------------------------------------------------------------------------------
def escape(text: Column) -> Column:
    r"""``\`` ``<`` ``|`` ``[`` become ``\s`` ``\l`` ``\p`` ``\b``: only letters follow a backslash, so codes cannot run together."""
    for plain, code in (("\\", "\\s"), ("<", "\\l"), ("|", "\\p"), ("[", "\\b")):
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    """Every backslash of an escaped text begins a code and none is produced before the last step."""
    for code, plain in (("\\l", "<"), ("\\p", "|"), ("\\b", "["), ("\\n", "\n"), ("\\s", "\\")):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _pieces(turn: Column) -> Column:
    role = F.replace(escape(turn["role"]), F.lit("\n"), F.lit("\\n"))
    return F.struct(F.concat(F.lit(OPEN), role, F.lit("\n")).alias("head"), escape(turn["text"]).alias("body"),
                    (turn["role"] == ASSISTANT).alias("learned"))


def format_chats(df: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(conv_id, formatted, loss array<struct<start, length>>): spans of assistant texts in code points from 1."""
    pieces = canonical_turns(df, layouts).select("conv_id", F.transform("turns", _pieces).alias("pieces"))
    formatted = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "")
    start = lambda done, p: done + F.char_length(p["head"]) + 1
    span = lambda done, p: F.struct(start(done, p).alias("start"), F.char_length(p["body"]).alias("length"))
    state = F.struct(F.lit(0).alias("done"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    walked = F.aggregate("pieces", state, lambda s, p: F.struct(
        (s["done"] + F.char_length(p["head"]) + F.char_length(p["body"]) + len(CLOSE)).alias("done"),
        F.when(p["learned"], F.concat(s["spans"], F.array(span(s["done"], p)))).otherwise(s["spans"]).alias("spans")))
    return pieces.select("conv_id", formatted.alias("formatted"), walked["spans"].alias("loss"))


def read_chats(chats: DataFrame) -> DataFrame:
    """Formatted chats back to (conv_id, formatted, turns array<struct<role, text>>, learned: the text under the loss mask)."""
    def parse(block: Column) -> Column:
        cut = F.instr(block, "\n")
        body = F.substring(block, cut + 1, F.char_length(block) - cut)
        return F.struct(unescape(F.substring(block, F.lit(1), cut - 1)).alias("role"), unescape(body).alias("text"))

    ends = F.split("formatted", F.lit(CLOSE.replace("|", r"\|")))
    blocks = F.transform(F.slice(ends, F.lit(1), F.size(ends) - 1), lambda b: F.substring(b, F.lit(len(OPEN) + 1), F.char_length(b)))
    learned = F.array_join(F.transform(
        "loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"], s["length"]))), "")
    return chats.select("conv_id", "formatted", F.transform(blocks, parse).alias("turns"), learned.alias("learned"))
