"""A whole run: landing to bronze to silver, for all tables."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from tidemark.plans.bronze import ingest
from tidemark.plans.jobs import together
from tidemark.plans.silver import Merged, refine
from tidemark.retail import ORDERS, RETAIL
from tidemark.sources.layers import publish
from tidemark.sources.store import Lake
from tidemark.spec import Batch, TableSpec


@dataclass(frozen=True)
class Retention:
    """What stays when a run is merged: its intermediate tables, its landed rows, old main versions."""

    staging: bool = True
    bronze: bool = True
    versions: int | None = None


def consume(lake: Lake, batch: Batch, spec: TableSpec, retention: Retention) -> None:
    """Drop what is not kept of a merged batch. A batch that is not merged yet is left alone."""
    if not lake.is_done(batch.ingestion_id, f"{spec.name}.merged"):
        return
    if not retention.staging:
        lake.drop_staging(spec, batch.ingestion_id)
    if not retention.bronze:
        lake.retire_bronze(spec, batch.ingestion_id)
    if retention.versions is not None:
        lake.expire(spec, retention.versions)


def new_batch(lake: Lake, when: dt.datetime) -> Batch:
    """Claim the next run number. Two callers cannot get the same one."""
    batch = Batch.at(lake.next_ingestion_id(), when)
    lake.files.create_text(f"{lake.root}/batches/{batch.ingestion_id}.started", when.isoformat())
    return batch


def _chains(specs: dict[str, TableSpec]) -> list[list[TableSpec]]:
    """Tables that must follow each other: those with carried columns come after the orders."""
    after_orders = [s for s in specs.values() if s.carried]
    chains = [[s] for s in specs.values() if not s.carried and s is not ORDERS]
    orders = [s for s in specs.values() if s is ORDERS]
    return [chain for chain in (orders + after_orders, *chains) if chain]


def refine_all(
    lake: Lake, batch: Batch, specs: dict[str, TableSpec] = RETAIL, parallel: bool = False
) -> dict[str, Merged | None]:
    """Clean and merge every table, one by one or as concurrent Spark jobs."""

    def refine_chain(chain: list[TableSpec]) -> dict[str, Merged | None]:
        # Rows that have taken a date from the orders move with it, those of a table with a batch of its own when that is merged.
        after = [s for s in chain if s.carried]
        run = batch.ingestion_id
        later = [s for s in after if lake.has_bronze(s, run) and not lake.is_done(run, f"{s.name}.merged")]
        at_once = [s for s in after if s not in later]
        dated = lake.has_bronze(ORDERS, run)
        return {
            spec.name: refine(
                lake, spec, batch, followers=at_once if spec is ORDERS else (), follows=dated and spec in later
            )
            for spec in chain
        }

    results = together(
        [lambda c=chain: refine_chain(c) for chain in _chains(specs)],
        at_once=None if parallel else 1,
    )
    return {name: merged for chain in results for name, merged in chain.items()}


def run(
    lake: Lake,
    landing: str,
    batch: Batch,
    specs: dict[str, TableSpec] = RETAIL,
    archive: str | None = None,
    parallel: bool = False,
    retention: Retention = Retention(),
    catalog: bool = False,
) -> dict[str, Merged | None]:
    """Land the files of one folder and bring every silver table up to date.

    ``retention`` says what stays afterwards; by default everything does. ``catalog`` puts the tables,
    as they are then, under their names in the catalog.
    """
    ingest(lake, landing, batch, specs, archive)
    merged = refine_all(lake, batch, specs, parallel)
    for spec in specs.values():
        consume(lake, batch, spec, retention)
    if catalog:
        publish(lake, specs)
    return merged
