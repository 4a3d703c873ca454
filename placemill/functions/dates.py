"""Mixed-calendar date strings to ``YYYY-MM-DD`` ('' when unknown), as one built-in expression."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from placemill import vocab
from placemill.functions.text import strip

# fixed values: the date shapes in use
_ISO = r"^([0-9]{4})[/\-.]([0-9]{1,2})[/\-.]([0-9]{1,2})\n?\z"
_ERA = r"^([MTSHR明大昭平令][^0-9]*)([0-9]{1,2})[/\-.年]([0-9]{1,2})[/\-.月]([0-9]{1,2})日?\n?\z"
_SERIAL = r"^[0-9]{4,5}\z"

# every decimal digit of the basic plane and the ASCII digit it stands for, by rule
_DIGITS = [(ch, str(unicodedata.decimal(ch))) for ch in map(chr, range(128, min(sys.maxunicode, 0x10000)))
           if unicodedata.category(ch) == "Nd"]


def ascii_digits(c: Column) -> Column:
    """Fold decimal digits of any script to 0-9."""
    return F.translate(c, "".join(d[0] for d in _DIGITS), "".join(d[1] for d in _DIGITS))


def _date_text(year: Column, month: Column, day: Column) -> Column:
    """'' for impossible dates: the cast of the assembled text is NULL for those."""
    text = F.concat_ws("-", F.lpad(year, 4, "0"), month, day)
    valid = F.when(~year.rlike(r"^0+\z"), text)
    return F.coalesce(valid.try_cast("date").cast("string"), F.lit(""))


def normalize_date(c: Column) -> Column:
    """First rule that applies decides: blank words, Excel serial, Western date, era date, else ''."""
    trimmed = strip(c)
    s = ascii_digits(F.substring_index(trimmed, " ", 1))
    low, high = vocab.EXCEL_SERIAL_RANGE
    serial = F.when(s.rlike(_SERIAL), s.cast("int"))
    era = F.regexp_extract(s, _ERA, 1)
    era_key = F.when(era.rlike("^[MTSHR]"), F.substring(era, 1, 1)).otherwise(F.substring(era, 1, 2))
    base = F.try_element_at(
        F.create_map(*[F.lit(x) for pair in vocab.ERA_BASE for x in pair]), era_key
    )
    era_year = (base + F.regexp_extract(s, _ERA, 2).try_cast("int")).cast("string")
    return (
        F.when(c.isNull() | (trimmed == "") | F.lower(trimmed).isin(*vocab.BLANK_DATE_WORDS), F.lit(""))
        .when(serial.between(low, high),
              F.date_add(F.lit(vocab.EXCEL_EPOCH).cast("date"), serial).cast("string"))
        .when(s.rlike(_ISO), _date_text(*[F.regexp_extract(s, _ISO, i) for i in (1, 2, 3)]))
        .when(s.rlike(_ERA) & base.isNotNull(),
              _date_text(era_year, F.regexp_extract(s, _ERA, 3), F.regexp_extract(s, _ERA, 4)))
        .otherwise(F.lit(""))
    )
