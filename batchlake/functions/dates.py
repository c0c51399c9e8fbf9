"""Dates, timestamps and run identity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from batchlake.functions.text import ustrip

# The accepted date layouts, tried in this order. Each has a guard so a layout
# takes exactly the digits it names.
DATE_LAYOUTS = {
    "%Y-%m-%d": (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    "%m/%d/%y": (r"^\d{1,2}/\d{1,2}/\d{2}$", "M/d/yy"),
    "%m/%d/%Y": (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    "%Y/%m/%d": (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
}

ISO_Z = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def standardize_date(c: Column, layouts: list[str] | None = None) -> Column:
    """DATE of a text in one of the accepted layouts; NULL if blank or in none of them.

    Two-digit years 69..99 mean 19xx, 00..68 mean 20xx.
    """
    text = ustrip(c)
    tried = []
    for layout in layouts or list(DATE_LAYOUTS):
        guard, pattern = DATE_LAYOUTS[layout]
        day = F.try_to_date(text, pattern)
        if pattern.endswith("/yy"):
            day = F.when(F.year(day) >= 2069, F.add_months(day, -1200)).otherwise(day)
        tried.append(F.when(text.rlike(guard) & (F.year(day) >= 1), day))
    return F.coalesce(*tried)


def date_unparsed(c: Column, layouts: list[str] | None = None) -> Column:
    """True for a text that is neither blank nor a date. Never NULL."""
    return F.coalesce((ustrip(c) != ""), F.lit(False)) & standardize_date(c, layouts).isNull()


def partition_parts(ts: Column) -> dict[str, Column]:
    """Zero-padded year, month and day of an ISO text, in the text's own offset."""
    layout = r"^(\d{4})-?(\d{2})-?(\d{2})"
    return {
        part: F.regexp_extract(ts, layout, i)
        for i, part in enumerate(["year", "month", "day"], start=1)
    }


def event_timestamp(c: Column, run_ts: str) -> Column:
    """A valid ISO text kept (``+00:00`` as ``Z``), anything else the run's timestamp."""
    iso = c.rlike(r"^\d{4}-?\d{2}-?\d{2}") & F.try_to_timestamp(c).isNotNull()
    return F.when(iso, F.replace(c, F.lit("+00:00"), F.lit("Z"))).otherwise(F.lit(run_ts))


def parse_timestamp(c: Column) -> Column:
    """TIMESTAMP of an ISO text; blank or malformed -> NULL."""
    return F.try_to_timestamp(F.nullif(c, F.lit("")))


def iso_z(ts: Column) -> Column:
    """ISO text with a ``Z`` for a UTC timestamp, whole seconds."""
    return F.date_format(ts, ISO_Z)


def duration_ms(start: Column, end: Column) -> Column:
    return F.unix_millis(end) - F.unix_millis(start)


def file_batch_id(path: Column, modified: Column, size: Column) -> Column:
    """The same file always gets the same id, so a replay cannot make a second batch."""
    return F.sha2(
        F.concat_ws("|", path, modified.cast("string"), size.cast("string")), 256
    )
