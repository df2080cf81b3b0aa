"""Duplicate handling: the latest row per key, and counts of copies."""

from __future__ import annotations

from pyspark.sql import Column as Col
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import identity_text
from tidemark.spec import TableSpec


def keyed(spec: TableSpec, bronze: DataFrame) -> DataFrame:
    """Landing rows with their key columns replaced by the text the key is grouped on."""
    return bronze.select(
        *[(identity_text(c) if c.name in spec.key else F.col(c.name)).alias(c.name) for c in spec.columns],
        "created_at_bronze",
        "source_file_id",
    )


def _key_print(spec: TableSpec) -> Col:
    """64 bits of a row's grouped key. Rows of one key agree in them; rows of others may, too."""
    return F.xxhash64(*[identity_text(c) for c in spec.columns if c.name in spec.key]).alias("_key")


def shared_prints(spec: TableSpec, bronze: DataFrame) -> DataFrame:
    """Prints of keys (column _key) that several landing rows have. What is shuffled of a row is 8 bytes."""
    prints = bronze.select(_key_print(spec)).groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    return prints.filter("_n > 1").select("_key")


def latest_per_key(spec: TableSpec, bronze: DataFrame, shared: DataFrame | None = None) -> DataFrame:
    """One landing row per business key, the one loaded last, with its key columns grouped.

    ``shared`` is ``shared_prints(...)`` of these or more rows, best read back from where it was written, for
    batches in which few keys repeat: rows whose print is their own are then neither sorted nor shuffled.
    """
    if shared is None:
        return _newest(spec, bronze)
    printed = bronze.select("*", _key_print(spec))
    alone = printed.join(shared, "_key", "left_anti")
    return keyed(spec, alone).unionByName(_newest(spec, printed.join(shared, "_key", "left_semi")))


def _newest(spec: TableSpec, bronze: DataFrame) -> DataFrame:
    """The row of each key that was loaded last.

    Equal load times are settled by the landing text of the other columns, so the outcome does not
    depend on how rows are spread over files. Spark keeps only one row per key in each task before
    the shuffle, so a key holding a large share of the rows sends at most one row per task.
    """
    newest_first = Window.partitionBy(*spec.key).orderBy(
        F.col("created_at_bronze").desc_nulls_first(),
        *[F.col(n).desc_nulls_last() for n in spec.payload],
        F.col("source_file_id").desc_nulls_last(),
    )
    return (
        keyed(spec, bronze)
        .withColumn("_position", F.row_number().over(newest_first))
        .filter("_position = 1")
        .drop("_position")
    )


def _versions(spec: TableSpec, bronze: DataFrame) -> DataFrame:
    return bronze.groupBy(*spec.names).agg(F.count(F.lit(1)).alias("copies"))


def _fingerprint(spec: TableSpec) -> list[Col]:
    """128 bits of a row's business columns. Hashes pass over NULLs, so these are told apart beside them."""
    nulls = [F.col(n).isNull() for n in spec.names]
    return [F.xxhash64(F.lit(seed), *spec.names, *nulls).alias(f"_print_{seed}") for seed in (1, 2)]


def duplicate_count(
    spec: TableSpec, bronze: DataFrame, shared: DataFrame | None = None, many: bool = False
) -> DataFrame:
    """One row: how many landing rows are exact copies of another in all business columns.

    Rows are first counted by a fingerprint, so what is shuffled of a row that is alone is 16 bytes. Only
    rows whose fingerprint is seen twice are compared in full. Copies have one key, so with ``shared``, as
    in ``latest_per_key``, only rows whose key's print is in it are counted at all.

    With ``many`` repeated keys the fingerprints seen twice can be too many to be broadcast. Finding their rows would
    then shuffle all of them, so rows are compared in full at once, those alike in a task once.
    """
    if many:
        return _copies(_versions(spec, bronze))
    if shared is not None:
        bronze = bronze.select("*", _key_print(spec)).join(shared, "_key", "left_semi")
    prints = _fingerprint(spec)
    names = [f"_print_{seed}" for seed in (1, 2)]
    seen = bronze.select(*prints).groupBy(*names).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    alike = bronze.select(*spec.names, *prints).join(seen.select(*names), names, "left_semi")
    return _copies(_versions(spec, alike))


def _copies(versions: DataFrame) -> DataFrame:
    return versions.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("bigint").alias("duplicate_count"))


def key_conflict_count(spec: TableSpec, bronze: DataFrame) -> DataFrame:
    """One row: how many keys arrive with more than one distinct set of business values."""
    keys = [identity_text(c).alias(f"_{c.name}") for c in spec.columns if c.name in spec.key]
    return (
        _versions(spec, bronze)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("versions"))
        .agg(F.count_if(F.col("versions") > 1).alias("key_conflict_count"))
    )
