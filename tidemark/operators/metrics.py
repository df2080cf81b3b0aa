"""Row-count and timing summaries of runs, as DataFrames."""

from __future__ import annotations

import functools

from pyspark.sql import Column as Col
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The two stages a file is logged for.
DAILY, HISTORY = "bronze_daily", "bronze_raw"

FILE_LOG = (
    "ingestion_id bigint, source_file_id string, source_file_name string, table_name string, "
    "ingestion_for string, row_count bigint, executing_time double, created_at timestamp_ntz"
)

RUN_LOG = (
    "ingestion_id bigint, table_name string, "
    "bronze_daily_row_count bigint, bronze_main_row_count bigint, "
    "silver_daily_row_count bigint, silver_main_row_count bigint, "
    "silver_daily_insert_executing_time double, silver_daily_indexing_time double, "
    "silver_main_insert_executing_time double, silver_main_update_executing_time double, "
    "total_silver_process_executing_time double, bronze_daily_copy_executing_time double, "
    "bronze_daily_indexing_time double, bronze_main_copy_executing_time double, "
    "total_bronze_process_executing_time double, silver_daily_null_pk_count bigint, "
    "silver_daily_required_null_count bigint, silver_daily_duplicate_count bigint, "
    "silver_daily_future_past_count bigint, silver_daily_negative_count bigint, "
    "created_at timestamp_ntz"
)


def file_counts(bronze: DataFrame) -> DataFrame:
    """Rows per source file of one table."""
    return bronze.groupBy("source_file_id").agg(F.count(F.lit(1)).alias("row_count"))


def file_log(
    counts: DataFrame, table: str, ingestion_id: int, seconds: Col, created_at: Col
) -> DataFrame:
    """File counts in the shape of the file log: one row per file and stage.

    One load serves both stages, so both rows carry the same count and time.
    """
    stages = F.array(F.lit(DAILY), F.lit(HISTORY))
    return counts.select(
        F.lit(ingestion_id).cast("bigint").alias("ingestion_id"),
        "source_file_id",
        F.element_at(F.split("source_file_id", "/"), -1).alias("source_file_name"),
        F.lit(table).alias("table_name"),
        F.explode(stages).alias("ingestion_for"),
        "row_count",
        seconds.cast("double").alias("executing_time"),
        created_at.alias("created_at"),
    )


def bronze_summary(log: DataFrame) -> DataFrame:
    """One row per run and table: rows and longest load per stage.

    One load serves both stages, so the total is the longer of the two, and NULL if either is missing.
    A table's files are loaded together: every file carries the seconds of its table. Nothing is
    indexed here, so the indexing time is zero.
    """
    daily, history = F.col(f"{DAILY}_seconds"), F.col(f"{HISTORY}_seconds")
    return (
        log.groupBy("ingestion_id", "table_name")
        .pivot("ingestion_for", [DAILY, HISTORY])
        .agg(F.sum("row_count").alias("rows"), F.max("executing_time").alias("seconds"))
        .select(
            "ingestion_id",
            "table_name",
            F.col(f"{DAILY}_rows").alias("bronze_daily_row_count"),
            F.col(f"{HISTORY}_rows").alias("bronze_main_row_count"),
            daily.alias("bronze_daily_copy_executing_time"),
            F.lit(0.0).alias("bronze_daily_indexing_time"),
            history.alias("bronze_main_copy_executing_time"),
            F.when(daily.isNotNull() & history.isNotNull(), F.greatest(daily, history)).alias(
                "total_bronze_process_executing_time"
            ),
        )
    )


def rows_loaded(log: DataFrame, table: str, ingestion_id: int, stage: str) -> DataFrame:
    """One row: rows loaded for a table, run and stage."""
    return _entries(log, table, ingestion_id, stage).agg(F.sum("row_count").alias("row_count"))


def longest_load(log: DataFrame, table: str, ingestion_id: int, stage: str) -> DataFrame:
    """One row: the longest load of a table, run and stage."""
    return _entries(log, table, ingestion_id, stage).agg(
        F.max("executing_time").alias("executing_time")
    )


def _entries(log: DataFrame, table: str, ingestion_id: int, stage: str) -> DataFrame:
    return log.filter(
        (F.col("table_name") == table)
        & (F.col("ingestion_id") == ingestion_id)
        & (F.col("ingestion_for") == stage)
    )


def rows_by_run(log: DataFrame) -> DataFrame:
    """Rows loaded per table and run, newest run first."""
    return (
        log.groupBy("table_name", "ingestion_id")
        .agg(F.sum("row_count").alias("row_count"))
        .orderBy(F.desc("ingestion_id"), "table_name")
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, frames)
