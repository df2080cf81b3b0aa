"""Helpers of several test files."""

import datetime as dt

from tidemark.spec import Batch

SMALL = "/root/testdata/sf0.001"


def day_batch(ingestion_id: int, day: str) -> Batch:
    return Batch.at(ingestion_id, dt.datetime.fromisoformat(day))


def bronze(spark, spec, rows, at="2024-01-01 00:00:00"):
    """A bronze frame from tuples of landing text, all loaded at once unless a row adds its time."""
    width = len(spec.names)
    schema = ", ".join(f"{n} string" for n in spec.names)
    full = [(*r[:width], r[width] if len(r) > width else at, "1/f.csv") for r in rows]
    return spark.createDataFrame(
        full, f"{schema}, loaded string, source_file_id string"
    ).selectExpr(
        *spec.names, "cast(loaded as timestamp_ntz) as created_at_bronze", "source_file_id"
    )


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
