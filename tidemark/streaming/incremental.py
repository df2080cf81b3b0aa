"""Incremental runs: process landing files that no earlier run has seen, then stop.

``follow`` takes the files of all tables from one source, a run for each micro-batch. ``start`` and
``catch_up`` give single tables queries of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.bronze import claim, land_rows
from tidemark.plans.run import Retention, run
from tidemark.plans.silver import refine
from tidemark.retail import ORDERS, RETAIL
from tidemark.sources.landing import FILE, FOUND, csv_options, described, scan_schema, with_lineage
from tidemark.sources.store import Lake
from tidemark.spec import Batch, TableSpec


def start(
    lake: Lake,
    spec: TableSpec,
    landing: str,
    batch_of: Callable[[int], Batch],
    checkpoint: str,
    archive: str | None = None,
    max_files: int | None = None,
    specs: dict[str, TableSpec] = RETAIL,
) -> StreamingQuery:
    """Start a query that takes every new file of a table through bronze and silver once.

    The checkpoint remembers which files were seen. ``batch_of`` turns the number of a micro-batch
    into a run, another one for each: a run that holds one micro-batch refuses a second, so no file is
    marked as seen without being loaded. A micro-batch repeated after a failure gets the same run,
    replaces its own bronze folder and is not merged twice. Files with rows are logged as in batch
    runs. ``archive`` moves finished files away. ``specs`` are the tables files are routed among.
    """

    def process(lines: DataFrame, epoch: int) -> None:
        batch = batch_of(epoch)
        lake.bind_epoch(spec, batch.ingestion_id, epoch)
        if lake.is_done(batch.ingestion_id, f"{spec.name}.merged"):
            return
        # Lineage is bound to the run, so it is completed here.
        land_rows(lake, spec, with_lineage(spec, lines, batch, specs), batch)
        after = [s for s in specs.values() if s.carried] if spec is ORDERS else ()
        refine(lake, spec, batch, followers=after)

    reader = (
        lake.spark.readStream.schema(scan_schema(spec))
        .options(**csv_options(spec, check_header=True))
        .option("latestFirst", "false")
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return (
        reader.csv(landing)
        .select("*", "_metadata")
        .writeStream.trigger(availableNow=True)
        .option("checkpointLocation", f"{checkpoint}/{spec.name}")
        .foreachBatch(process)
        .start()
    )


def catch_up(
    lake: Lake,
    specs: list[TableSpec],
    landing: str,
    batch_of: Callable[[int], Batch],
    checkpoint: str,
    archive: str | None = None,
) -> None:
    """Process all files waiting for the given tables and return when done.

    Tables that look values up in the orders come after them.
    """
    routed = RETAIL | {s.name: s for s in specs}
    for spec in sorted(specs, key=lambda s: bool(s.carried)):
        start(lake, spec, landing, batch_of, checkpoint, archive, specs=routed).awaitTermination()


def follow(
    lake: Lake,
    landing: str,
    batch_of: Callable[[int], Batch],
    checkpoint: str,
    archive: str | None = None,
    max_files: int | None = None,
    specs: dict[str, TableSpec] = RETAIL,
    retention: Retention = Retention(),
) -> StreamingQuery:
    """Start one query that takes every new file of the landing folder, of whatever table, once.

    The stream carries names only: each micro-batch is routed by file name, claimed as the files of a
    run and handed to a whole run, which reads them, orders before the items that take their dates.
    A micro-batch repeated after a failure finds its claim and goes on where its run has stopped.
    ``archive`` moves files away once a later micro-batch has begun, as Spark's file source does.
    Files that no table claims are reported by the run and written in its registry.
    """

    def process(files: DataFrame, epoch: int) -> None:
        batch = batch_of(epoch)
        for spec in specs.values():
            lake.bind_epoch(spec, batch.ingestion_id, epoch)
        if not lake.has_registry(batch.ingestion_id):
            claim(lake, files, batch)
        run(lake, landing, batch, specs, parallel=True, retention=retention)

    reader = lake.spark.readStream.format("binaryFile").schema(FILE).options(**FOUND)
    reader = reader.option("latestFirst", "false")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return (
        described(reader.load(landing), specs)
        .writeStream.trigger(availableNow=True)
        .option("checkpointLocation", f"{checkpoint}/all")
        .foreachBatch(process)
        .start()
    )
