"""Bronze text to typed silver rows, and rejected rows to JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import moment, settled, typed
from tidemark.spec import Batch, TableSpec

# Whole microseconds, so nothing of a timestamp is lost in the JSON.
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def project(spec: TableSpec, rows: DataFrame, batch: Batch, grouped: bool = False) -> DataFrame:
    """The typed projection of a table, with lineage kept and the audit time of this run added.

    ``grouped`` rows come from ``latest_per_key`` and hold their key columns normalised already.
    """
    return rows.select(
        *[
            (settled(F.col(c.name)) if grouped and c.name in spec.key else typed(c)).alias(c.name)
            for c in spec.columns
        ],
        "created_at_bronze",
        moment(batch.cleaned_at).alias("created_at_silver"),
        "source_file_id",
    )


def row_json(df: DataFrame) -> DataFrame:
    """Every row as one JSON object in ``raw_row``, with NULL fields written out."""
    return df.withColumn("raw_row", F.to_json(F.struct(*df.columns), JSON_OPTIONS))
