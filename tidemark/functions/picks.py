"""Deterministic choices: the same row number and purpose always give the same pick."""

from __future__ import annotations

from pyspark.sql import Column as Col
from pyspark.sql import functions as F


def pick(row: Col, purpose: str, choices: Col | int) -> Col:
    """A whole number in [0, choices) drawn from the MD5 of the row number and the purpose."""
    digest = F.md5(F.concat_ws(":", row.cast("string"), F.lit(purpose)))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.pmod(number, choices if isinstance(choices, Col) else F.lit(choices).cast("bigint"))


def one_of(row: Col, purpose: str, values: tuple) -> Col:
    """One of a short fixed list of values."""
    options = F.array(*[F.lit(v) for v in values])
    return F.element_at(options, pick(row, purpose, len(values)).cast("int") + 1)
