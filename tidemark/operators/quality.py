"""Row rules, rejects and key checks."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column as Col
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import missing, moment, too_long
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.project import project, row_json
from tidemark.spec import KEY_TOO_LONG, MALFORMED, Batch, TableSpec


class KeyViolation(RuntimeError):
    """A table holds a business key more than once."""


def _any(conditions) -> Col:
    return functools.reduce(operator.or_, conditions)


def reject_reason(spec: TableSpec, batch: Batch) -> Col:
    """The first rule a row breaks, or NULL for a good row."""
    latest = F.date_add(F.lit(batch.as_of), 1)
    keys = [c for c in spec.columns if c.name in spec.key]
    required = [c for c in spec.columns if c.name in spec.payload]
    reason = (
        F.when(_any(missing(c) for c in keys), "missing_pk")
        .when(_any(too_long(c) for c in keys), KEY_TOO_LONG)
        .when(_any(missing(c) for c in required), "missing_required_fields")
    )
    if spec.dated:
        outside = _any(
            (F.col(d) > latest) | (F.col(d) < F.lit(batch.min_date)) for d in spec.dated
        )
        reason = reason.when(outside, "future_or_past_date")
    if spec.non_negative:
        reason = reason.when(_any(F.col(n) < 0 for n in spec.non_negative), spec.negative_label)
    return reason


def tag(spec: TableSpec, typed_rows: DataFrame, batch: Batch) -> DataFrame:
    """Add ``reject_reason``; nothing is dropped."""
    return typed_rows.withColumn("reject_reason", reject_reason(spec, batch))


def checked(spec: TableSpec, bronze: DataFrame, batch: Batch, shared: DataFrame | None = None) -> DataFrame:
    """Landing rows of one batch to one tagged silver row per key; ``shared`` as in ``latest_per_key``."""
    latest = latest_per_key(spec, well_formed(bronze), shared)
    return tag(spec, project(spec, latest, batch, grouped=True), batch)


def well_formed(bronze: DataFrame) -> DataFrame:
    """Rows whose landing line had the right number of fields."""
    return bronze.filter(F.col(MALFORMED).isNull()) if MALFORMED in bronze.columns else bronze


def clean(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("reject_reason").isNotNull())


def quarantine_rows(spec: TableSpec, tagged: DataFrame, batch: Batch) -> DataFrame:
    """Rejected rows in the shape of the quarantine table."""
    rows = rejected(tagged)
    return row_json(rows).select(*_quarantine_head(spec, batch), "reject_reason", "raw_row")


def malformed_rows(spec: TableSpec, bronze: DataFrame, batch: Batch) -> DataFrame:
    """Landing lines with too few or too many fields, in the shape of the quarantine table."""
    lines = bronze.filter(F.col(MALFORMED).isNotNull()).select(
        MALFORMED, "created_at_bronze", "source_file_id"
    )
    return row_json(lines).select(
        *_quarantine_head(spec, batch), F.lit("malformed_row").alias("reject_reason"), "raw_row"
    )


def _quarantine_head(spec: TableSpec, batch: Batch) -> list[Col]:
    return [
        F.lit(batch.ingestion_id).cast("bigint").alias("ingestion_id"),
        F.lit(spec.name).alias("table_name"),
        moment(batch.cleaned_at).alias("flagged_at"),
    ]


def reject_counts(tagged: DataFrame) -> DataFrame:
    """Rows per reject reason; good rows are counted under ``clean``."""
    return tagged.groupBy(F.coalesce("reject_reason", F.lit("clean")).alias("reject_reason")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


def reject_summary(spec: TableSpec, tagged: DataFrame) -> DataFrame:
    """One row of counts: clean rows and every reason this table can give, 0 where none."""
    reason = F.col("reject_reason")
    return tagged.agg(
        F.count_if(reason.isNull()).alias("clean"),
        *[F.count_if(reason == label).alias(label) for label in spec.reject_labels],
    )


def key_violations(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Keys that occur more than once."""
    return (
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter(F.col("row_count") > 1)
    )


def key_check(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """One row: number of rows and number of keys that occur more than once, in one pass."""
    return (
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("row_count"),
            F.count_if(F.col("n") > 1).alias("violations"),
        )
    )


def assert_unique(df: DataFrame, key: tuple[str, ...], what: str) -> int:
    """Raise if a key repeats, else return the number of rows.

    Keys are counted by 64 bits of them. Only if some rows agree in those are all keys compared in full.
    """
    prints = df.select(F.xxhash64(*key).alias("_key"))
    rows, violations = key_check(prints, ("_key",)).first()
    if violations:
        rows, violations = key_check(df, key).first()
    if violations:
        raise KeyViolation(f"{what}: {violations} repeated values of key ({', '.join(key)})")
    return rows


def assert_history(spec: TableSpec, history: DataFrame) -> None:
    """A history table holds one row per key and start, and at most one valid row per key."""
    assert_unique(history, spec.identity, f"{spec.name} history")
    assert_unique(history.filter("is_valid"), spec.key, f"{spec.name} current rows")


def reconciliation(spec: TableSpec, bronze: DataFrame, tagged: DataFrame) -> DataFrame:
    """One row: rows in = malformed + dropped as older versions + rejected + clean."""
    nothing = F.lit(0).cast("bigint")
    is_rejected = F.col("reject_reason").isNotNull()
    broken = F.count(MALFORMED) if MALFORMED in bronze.columns else nothing
    arrived = bronze.agg(
        F.count(F.lit(1)).alias("daily_in"),
        broken.alias("malformed"),
        nothing.alias("rejected"),
        nothing.alias("clean"),
    )
    kept = tagged.agg(
        nothing.alias("daily_in"),
        nothing.alias("malformed"),
        F.count_if(is_rejected).alias("rejected"),
        F.count_if(~is_rejected).alias("clean"),
    )
    parts = ("malformed", "rejected", "clean")
    older = F.col("daily_in") - F.col("malformed") - F.col("rejected") - F.col("clean")
    return (
        arrived.unionByName(kept)
        .agg(*[F.sum(c).alias(c) for c in ("daily_in", *parts)])
        .select(
            F.lit(spec.name).alias("table_name"), "daily_in", older.alias("dropped_by_dedup"), *parts
        )
    )
