"""Scalar Column builders (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def flag(pred: Column) -> Column:
    """1 when ``pred`` is true, else 0; a NULL predicate gives 0."""
    return F.when(pred, F.lit(1)).otherwise(F.lit(0))


def classify(branches: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """Ordered labelling: the first branch whose predicate is true wins.

    With ``default=None`` an unmatched row gets NULL (a CASE without ELSE).
    """
    if not branches:
        return F.lit(default)
    out = None
    for pred, label in branches:
        val = label if isinstance(label, Column) else F.lit(label)
        out = F.when(pred, val) if out is None else out.when(pred, val)
    if default is not None:
        out = out.otherwise(default if isinstance(default, Column) else F.lit(default))
    return out


def null_or_ne(col: ColumnOrName, value: object) -> Column:
    """``col IS NULL OR col <> value``."""
    c = _c(col)
    return c.isNull() | (c != F.lit(value))


def local_date(col: ColumnOrName, zone: str, date_first: bool = False) -> Column:
    """Calendar date in ``zone`` of a UTC instant.

    ``date_first`` cuts the time of day off before the shift, as the source's
    cast does: the result is the local date of that day's midnight UTC.

    Dates are read as midnight UTC, as the warehouse does after a ``::date``
    cast, so a western zone moves them to the previous day. Works on
    TIMESTAMP_NTZ input and does not depend on the session time zone.
    """
    ts = _c(col).cast("timestamp_ntz")
    if date_first:
        ts = ts.cast("date").cast("timestamp_ntz")
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), ts))


def year_month(col: ColumnOrName) -> Column:
    """'yyyy-MM' text of a date (the month pattern is upper-case MM)."""
    return F.date_format(_c(col), "yyyy-MM")


def days_between(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """Whole days between two dates, counted as date boundaries crossed."""
    return F.datediff(_c(later).cast("date"), _c(earlier).cast("date"))


def first_code(col: ColumnOrName) -> Column:
    """First element of a bracketed, quoted list held in a string.

    '["A","B"]' -> 'A', '[]' -> '', 'A' -> 'A', NULL -> NULL.
    """
    stripped = F.btrim(F.replace(_c(col), F.lit('"'), F.lit("")), F.lit("[|]"))
    return F.substring_index(stripped, ",", 1)


def ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """num / den as double; NULL when the denominator is 0 or NULL."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
