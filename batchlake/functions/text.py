"""Text clean-up and text rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as Unicode has it, plus the four ASCII separators U+001C..U+001F.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set inside a character class. Spelled out, it is much cheaper to match than the
# Unicode-aware \\s.
_WS = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# Cells that count as missing in the delimited input.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

_ADDRESS = rf"[^@{_WS}]+@[^@{_WS}]+\.[^@{_WS}]+"

# Most cells are printable ASCII, whose only white space is U+0020. There the rules have plain forms, which cost
# an eighth of the general ones for addresses and half for runs of blanks.
_PRINTABLE = r"^[\x20-\x7e]*\z"
_SOLID = r"^[\x21-\x7e]*\z"
_PLAIN_ADDRESS = r"[\x21-\x3f\x41-\x7e]+@[\x21-\x3f\x41-\x7e]+\.[\x21-\x3f\x41-\x7e]+"


def null_tokens(c: Column, tokens: list[str] | None = None) -> Column:
    """NULL for a cell that is exactly one of the missing-value tokens."""
    return F.when(~c.isin(NULL_TOKENS if tokens is None else tokens), c)


def ustrip(c: Column) -> Column:
    """Strip Unicode whitespace at both ends (``trim`` strips U+0020 only)."""
    return F.btrim(c, F.lit(SPACES))


def collapse(c: Column) -> Column:
    """Strip, and turn every inner run of whitespace into one blank."""
    c = c.cast("string")
    blanks = F.regexp_replace(F.trim(c), " +", " ")
    anything = F.regexp_replace(ustrip(c), f"[{_WS}]+", " ")
    return F.when(c.rlike(_SOLID), c).when(c.rlike(_PRINTABLE), blanks).otherwise(anything)


def present(c: Column) -> Column:
    """Neither NULL nor blank. Never NULL itself."""
    return F.coalesce(ustrip(c) != "", F.lit(False))


def is_email(c: Column) -> Column:
    """Something@something.something without blanks or a second @. Never NULL."""
    plain = c.rlike(rf"^\x20*{_PLAIN_ADDRESS}\x20*\z")
    general = c.rlike(rf"^[{_WS}]*{_ADDRESS}[{_WS}]*\z")
    return F.coalesce(F.when(c.rlike(_PRINTABLE), plain).otherwise(general), F.lit(False))


def normalize_name(c: Column) -> Column:
    """Blanks collapsed, every word lower case with a capital first letter; blank -> NULL."""
    return F.nullif(F.initcap(F.lower(collapse(c))), F.lit(""))


def normalize_email(c: Column) -> Column:
    """Stripped and lower case; blank -> NULL."""
    return F.nullif(F.lower(ustrip(c)), F.lit(""))


def safe_file_name(c: Column) -> Column:
    """Base name with every character outside ``A-Za-z0-9._-`` as ``_``; NULL unless ``.csv``."""
    base = F.regexp_replace(F.regexp_extract(c, r"([^/\\]*)$", 1), r"[^A-Za-z0-9._-]", "_")
    return F.when(F.lower(base).endswith(".csv"), base)


def base_name(c: Column) -> Column:
    return F.substring_index(c, "/", -1)


def day_label(year: Column, month: Column, day: Column) -> Column:
    """``2026-07-01`` from three parts, padding month and day."""
    return F.concat_ws(
        "-",
        year.cast("string"),
        F.lpad(month.cast("string"), 2, "0"),
        F.lpad(day.cast("string"), 2, "0"),
    )
