"""Text expressions that follow Unicode whitespace, unlike the engine's ASCII-only trim."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the code points (first, last) a Unicode strip removes
SPACES = (
    (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
    (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
)
SPACE_CHARS = "".join(chr(c) for first, last in SPACES for c in range(first, last + 1))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACE_CHARS))


def squeeze_out(c: Column) -> Column:
    """Remove every whitespace character."""
    return F.translate(c, SPACE_CHARS, "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def is_filled(c: Column) -> Column:
    """True when something other than whitespace is present; never NULL."""
    return F.coalesce(strip(c) != "", F.lit(False))


def join_filled(cols: Sequence[Column], sep: str = " ") -> Column:
    """Join the stripped non-blank values; '' when there is none."""
    return F.concat_ws(sep, *[blank_to_null(c) for c in cols])


def match_key(name: Column, address: Column, business_type: Column) -> Column:
    """Whitespace-free name|address|business_type."""
    return F.concat(
        squeeze_out(name), F.lit("|"), squeeze_out(address), F.lit("|"), squeeze_out(business_type)
    )
