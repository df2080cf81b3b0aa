"""Declarative table specifications: everything an operator needs to know about a table."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import types as T

TEXT, DATE, DECIMAL = "text", "date", "decimal"

SILVER_TYPES = {
    TEXT: T.StringType(),
    DATE: T.DateType(),
    DECIMAL: T.DecimalType(10, 2),
}

MALFORMED = "malformed_record"
# Why a row is rejected whose key is longer than its column.
KEY_TOO_LONG = "key_too_long"
AUDIT = ("created_at_bronze", "created_at_silver")


@dataclass(frozen=True)
class Column:
    """A business column: its landing name, silver kind and (for text) maximum length."""

    name: str
    kind: str = TEXT
    length: int = 255

    @property
    def silver_type(self) -> T.DataType:
        return SILVER_TYPES[self.kind]


@dataclass(frozen=True)
class TableSpec:
    """One table: landing layout, business key, rules and how its main table is kept.

    ``columns`` are in landing (positional) order. Every column outside ``key`` is required, and is
    compared when a batch is merged. ``month_of`` names the date column whose month partitions the
    main table; ``carried`` columns are looked up after cleaning and kept with the row without being
    compared. ``slots`` parts each month by key, for tables whose rows share few months.
    """

    name: str
    columns: tuple[Column, ...]
    key: tuple[str, ...]
    dated: tuple[str, ...] = ()
    non_negative: tuple[str, ...] = ()
    negative_label: str | None = None
    history: bool = False
    month_of: str | None = None
    carried: tuple[Column, ...] = ()
    slots: int = 1

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(c.name for c in self.columns)

    @property
    def payload(self) -> tuple[str, ...]:
        return tuple(n for n in self.names if n not in self.key)

    @property
    def carried_names(self) -> tuple[str, ...]:
        return tuple(c.name for c in self.carried)

    @property
    def reject_labels(self) -> tuple[str, ...]:
        """Labels this table's rules can give, in priority order."""
        labels = ["missing_pk", KEY_TOO_LONG, "missing_required_fields"]
        if self.dated:
            labels.append("future_or_past_date")
        if self.non_negative:
            labels.append(self.negative_label)
        return tuple(labels)

    @property
    def identity(self) -> tuple[str, ...]:
        """Columns that identify one row of the main table."""
        return self.key + (("valid_from",) if self.history else ())

    def landing_schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, T.StringType()) for n in self.names])

    def bronze_schema(self) -> T.StructType:
        return (
            self.landing_schema()
            .add(MALFORMED, T.StringType())
            .add("created_at_bronze", T.TimestampNTZType())
            .add("source_file_id", T.StringType())
        )

    def daily_schema(self) -> T.StructType:
        schema = T.StructType([T.StructField(c.name, c.silver_type) for c in self.columns])
        for name in AUDIT:
            schema.add(name, T.TimestampNTZType())
        return schema.add("source_file_id", T.StringType())

    def main_schema(self) -> T.StructType:
        schema = T.StructType(
            [T.StructField(c.name, c.silver_type) for c in self.columns + self.carried]
        )
        for name in AUDIT:
            schema.add(name, T.TimestampNTZType())
        if self.history:
            schema.add("valid_from", T.TimestampNTZType())
            schema.add("valid_to", T.TimestampNTZType())
            schema.add("is_valid", T.BooleanType())
        return schema


@dataclass(frozen=True)
class Batch:
    """The identity and clock of one run. Operators never ask the machine for the time.

    ``clock`` tells seconds for the timings that a run logs; a given one makes them values.
    """

    ingestion_id: int
    as_of: dt.date
    loaded_at: dt.datetime
    cleaned_at: dt.datetime
    min_date: dt.date = field(default=dt.date(2015, 1, 1))
    clock: Callable[[], float] = field(default=time.monotonic, compare=False)

    @classmethod
    def at(cls, ingestion_id: int, when: dt.datetime) -> Batch:
        """A batch whose load, clean and business dates all come from one instant."""
        return cls(ingestion_id, when.date(), when, when)
