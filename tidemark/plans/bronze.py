"""Landing to bronze: one scan and one write per table."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import moment
from tidemark.operators.metrics import bronze_summary, file_counts, file_log
from tidemark.plans.jobs import together
from tidemark.retail import RETAIL
from tidemark.session import while_writing
from tidemark.sources.landing import discover, scan
from tidemark.sources.store import Lake
from tidemark.spec import Batch, TableSpec

log = logging.getLogger("tidemark")


def land_rows(
    lake: Lake, spec: TableSpec, rows: DataFrame, batch: Batch, files: DataFrame | None = None
) -> None:
    """Write one table's landed rows and log its files.

    A run's rows serve as both its daily batch and its part of history. ``files`` (column
    file_name) are all files that were read, so those that hold only a header are logged with no rows.
    """
    started = batch.clock()
    with while_writing(lake.spark):
        lake.write_bronze(spec, rows, batch.ingestion_id)
    seconds = batch.clock() - started
    counts = file_counts(lake.bronze_daily(spec, batch.ingestion_id))
    if files is not None:
        known = files.select(
            F.concat(F.lit(f"{batch.ingestion_id}/"), "file_name").alias("source_file_id")
        )
        counts = known.join(counts, "source_file_id", "left").fillna(0, ["row_count"])
    entries = file_log(
        counts, spec.name, batch.ingestion_id, F.lit(seconds), moment(batch.loaded_at)
    )
    lake.write_log("files", entries, spec.name, batch.ingestion_id)
    log.info("%s: landed in %.1f s", spec.name, seconds)


def claim_files(
    lake: Lake, landing: str, batch: Batch, specs: dict[str, TableSpec] = RETAIL
) -> DataFrame:
    """The files of a run, written down before any is read; a repeated run gets the same ones.

    A file that an earlier run has claimed, unchanged since, is not claimed again.
    """
    if not lake.has_registry(batch.ingestion_id):
        claim(lake, discover(lake.spark, landing, specs), batch)
    return lake.registry().filter(F.col("ingestion_id") == batch.ingestion_id)


def claim(lake: Lake, found: DataFrame, batch: Batch) -> None:
    """Write down found files as those of a run, but for those that an earlier run has claimed."""
    seen = lake.registry().filter(F.col("ingestion_id") < batch.ingestion_id)
    state = ["path", "length", "modified"]
    lake.write_registry(found.join(seen.select(*state), state, "left_anti"), batch.ingestion_id)


def ingest(
    lake: Lake,
    landing: str,
    batch: Batch,
    specs: dict[str, TableSpec] = RETAIL,
    archive: str | None = None,
    check_header: bool = True,
) -> DataFrame:
    """Land every routed file as one run and return the run's bronze summary.

    Only files in the run's registry are read, logged and, if ``archive`` is given, moved there
    after every table has loaded. Tables without files are skipped and files no table claims are
    reported. A run already landed is not read again.
    """
    files = claim_files(lake, landing, batch, specs)
    if not lake.is_done(batch.ingestion_id, "landed"):
        paths: dict[str | None, list[str]] = {}
        for row in files.select("table_name", "path").collect():
            paths.setdefault(row["table_name"], []).append(row["path"])
        if None in paths:
            log.warning("%d landing files belong to no table", len(paths[None]))
        for spec in specs.values():
            if spec.name not in paths:
                log.info("%s: nothing landed", spec.name)

        def land(spec: TableSpec) -> None:
            rows = scan(lake.spark, spec, landing, batch, check_header, specs, paths[spec.name])
            land_rows(lake, spec, rows, batch, files.filter(F.col("table_name") == spec.name))

        together([lambda s=spec: land(s) for spec in specs.values() if spec.name in paths])
        lake.mark_done(batch, "landed")
    if archive:
        archive_files(lake, archive, batch)
    return bronze_summary(lake.file_log().filter(F.col("ingestion_id") == batch.ingestion_id))


#: Renames at once.
MOVES = 16


def archive_files(lake: Lake, archive: str, batch: Batch) -> list[str]:
    """Move the files that a run has loaded, and no others, to a folder of the same storage.

    The new name carries the run's number, so files of the same name on other days stay apart. A
    file that was moved before, or that has changed since it was loaded, is left alone.
    """
    lake.files.make_directory(archive)
    loaded = lake.registry().filter(
        (F.col("ingestion_id") == batch.ingestion_id) & F.col("table_name").isNotNull()
    )

    def move(row) -> str | None:
        found = lake.files.status(row["path"])
        if found != (row["length"], row["modified"]):
            return None
        target = f"{batch.ingestion_id}_{row['file_name']}"
        lake.files.move(row["path"], f"{archive}/{target}")
        return target

    moved = together([lambda r=row: move(r) for row in loaded.collect()], at_once=MOVES)
    return sorted(name for name in moved if name)
