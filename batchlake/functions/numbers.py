"""Number parsing and categories."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that counts as a number: ASCII blanks around an optional sign and digits, or infinity.
# The guard keeps out what a cast alone would let through ("1d", "NaN", hex floats).
_NUMBER = (
    r"^[ \t\n\x0b\f\r]*[+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|(?i:inf(inity)?))[ \t\n\x0b\f\r]*$"
)


def parse_number(c: Column) -> Column:
    """Double value of a numeric text, else NULL; never NaN, may be infinite."""
    return F.when(c.rlike(_NUMBER), c.try_cast("double"))


def is_number(c: Column) -> Column:
    """Whether the text is a number. Never NULL."""
    return F.coalesce(c.rlike(_NUMBER), F.lit(False))


def is_whole(d: Column) -> Column:
    """Whether a double has no fraction and is finite (infinity leaves NaN). NULL stays NULL."""
    return d % 1 == 0


def whole(d: Column) -> Column:
    """BIGINT of a double without fraction, else NULL. Values beyond BIGINT are NULL too."""
    return F.when(is_whole(d), d.try_cast("bigint"))


def parse_whole(c: Column) -> Column:
    """Whole number of a text as BIGINT, else NULL."""
    return whole(parse_number(c))


def sales_category(sales: Column) -> Column:
    """Below 500 Low, below 1000 Medium, else High."""
    return F.when(sales < 500, "Low").when(sales < 1000, "Medium").when(sales >= 1000, "High")


def percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100``; NULL for nothing."""
    return F.try_divide(part, whole) * 100
