"""Column expressions that turn landing text into silver values. All stay inside the JVM."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column as Col
from pyspark.sql import functions as F

from tidemark.spec import DATE, DECIMAL, TEXT, Column

# \z and not $: Java's $ also matches before a final line break.
ISO_DATE = r"^\d{4}-\d{2}-\d{2}\z"


def moment(value: dt.datetime) -> Col:
    """A time literal that no time zone setting can shift."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def plain(col: Col) -> Col:
    """Lower-case text without outer blanks."""
    return F.lower(F.trim(col))


def normalised(col: Col, length: int) -> Col:
    """Lower-case text without outer blanks, cut to ``length`` characters."""
    return F.substring(plain(col), 1, length)


def guarded_date(col: Col) -> Col:
    """The date written as YYYY-MM-DD, or NULL for any other shape or an impossible day."""
    text = F.trim(col)
    return F.when(text.rlike(ISO_DATE), text.try_cast("date"))


def money(col: Col) -> Col:
    """decimal(10,2), rounding half away from zero; NULL when it is no number or too large."""
    return F.trim(col).try_cast("decimal(10,2)")


def typed(column: Column) -> Col:
    """The silver value of a landing column."""
    raw = F.col(column.name)
    if column.kind == DATE:
        return guarded_date(raw)
    if column.kind == DECIMAL:
        return money(raw)
    return normalised(raw, column.length)


def missing(column: Column) -> Col:
    """True for a silver value that is NULL or, for text, empty."""
    value = F.col(column.name)
    if column.kind == TEXT:
        return value.isNull() | (value == "")
    return value.isNull()


def identity_text(column: Column) -> Col:
    """What a key column is grouped on: its normalised text, or the raw text where that is blank.

    Spellings of one key fall together, while NULL, empty and blank keys stay apart from each other
    as they are in the landing text. The text is never cut: keys that agree in their first characters
    only are different keys, and one that doesn't fit its column is rejected with all of its text.
    """
    return F.coalesce(F.nullif(plain(F.col(column.name)), F.lit("")), F.col(column.name))


def too_long(column: Column) -> Col:
    """True for a key that its column could hold a part of only."""
    return F.length(F.col(column.name)) > column.length


def settled(col: Col) -> Col:
    """The silver value of an identity text. It is normalised already, unless blank."""
    return F.when(F.trim(col) == "", "").otherwise(col)


# The month of rows without a date.
UNKNOWN = "unknown"


def month_of(col: Col) -> Col:
    """Partition label ``YYYY-MM``; rows without a date share ``unknown``."""
    return F.coalesce(F.substring(col.cast("string"), 1, 7), F.lit(UNKNOWN))
