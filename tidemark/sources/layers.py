"""Layers as catalog namespaces: create, reset and drop their tables, and keep them in step with a store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.retail import RETAIL
from tidemark.spec import TableSpec

# The four namespaces.
NAMESPACES = ("bronze", "silver", "gold", "operational_log")

LAYERS = {
    "bronze_main": ("bronze", "{}_raw", TableSpec.bronze_schema),
    "bronze_daily": ("bronze", "{}_raw_daily", TableSpec.bronze_schema),
    "silver_daily": ("silver", "{}_daily", TableSpec.daily_schema),
    "silver_main": ("silver", "{}", TableSpec.main_schema),
}


def create_namespaces(spark: SparkSession) -> None:
    for name in NAMESPACES:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def table_name(layer: str, spec: TableSpec) -> str:
    namespace, pattern, _ = LAYERS[layer]
    return f"{namespace}.{pattern.format(spec.name)}"


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def reset_layer(
    spark: SparkSession, layer: str, specs: dict[str, TableSpec] = RETAIL
) -> list[str]:
    """Drop and create every table of a layer, empty and with its declared schema."""
    names = drop_layer(spark, layer, specs)
    schema_of = LAYERS[layer][2]
    for name, spec in zip(names, specs.values(), strict=True):
        empty(spark, schema_of(spec)).write.format("parquet").mode("overwrite").saveAsTable(name)
    return names


def drop_layer(
    spark: SparkSession, layer: str, specs: dict[str, TableSpec] = RETAIL
) -> list[str]:
    names = [table_name(layer, spec) for spec in specs.values()]
    for name in names:
        forget(spark, name)
    return names


def forget(spark: SparkSession, name: str) -> None:
    """Drop a name of the catalog, whether it stands for a table or a view."""
    if spark.catalog.tableExists(name):
        kind = "VIEW" if spark.catalog.getTable(name).tableType == "VIEW" else "TABLE"
        spark.sql(f"DROP {kind} IF EXISTS {name}")


def _external(spark: SparkSession, name: str, schema: T.StructType, parts: list[str], path: str) -> None:
    """A partitioned table over folders that a store has written; dropping it leaves them."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    forget(spark, name)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({', '.join(parts)}) LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {name}")


def publish(lake, specs: dict[str, TableSpec] = RETAIL) -> list[str]:
    """Put a store's tables under their names in the catalog, and return those.

    A main table's name is a view of its version in force, a table in buckets with a partition for each
    of its parts; later merges show after the next call only. Landed rows, rejected rows and both logs
    are external tables over their folders. Tables without any rows so far are left out.
    """
    spark, names = lake.spark, []
    create_namespaces(spark)
    for spec in specs.values():
        bronze, main = table_name("bronze_main", spec), table_name("silver_main", spec)
        if lake.files.exists(lake.bronze_path(spec)):
            schema = T.StructType([*spec.bronze_schema(), T.StructField("ingestion_id", T.LongType())])
            _external(spark, bronze, schema, ["ingestion_id"], lake.bronze_path(spec))
            names.append(bronze)
        held = lake.manifest(spec)
        if held.number:
            forget(spark, main)
            columns = ", ".join(f"`{n}`" for n in spec.main_schema().names)
            spark.sql(f"CREATE OR REPLACE VIEW {main} AS SELECT {columns} FROM {lake.named(spec, held)}")
            names.append(main)
    for name, (schema, path) in lake.logs().items():
        if lake.files.exists(path):
            _external(spark, f"operational_log.{name}", schema, ["table_name", "ingestion_id"], path)
            names.append(f"operational_log.{name}")
    return names
