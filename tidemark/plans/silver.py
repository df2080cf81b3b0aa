"""Bronze to silver: clean one table's batch, then merge it into the main table."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import UNKNOWN, moment
from tidemark.operators import merge
from tidemark.operators.dedup import duplicate_count, shared_prints
from tidemark.operators.lookup import lookup, order_dates, with_order_date
from tidemark.operators.metrics import RUN_LOG, bronze_summary
from tidemark.operators.quality import (
    assert_history,
    assert_unique,
    checked,
    malformed_rows,
    quarantine_rows,
    reject_counts,
)
from tidemark.plans.jobs import together
from tidemark.retail import ORDERS
from tidemark.session import while_writing
from tidemark.sources.store import CURRENT, Lake, Manifest, Part
from tidemark.spec import Batch, TableSpec

log = logging.getLogger("tidemark")

# Repeated keys of a batch up to which its other rows are told apart by them: 8 MB, within Spark's broadcast threshold.
FEW_SHARED = 1 << 20
# A batch with more than one row for so many of the main table meets it in one join, which sorts both.
LARGE_SHARE = 16


@dataclass
class Cleaned:
    """What cleaning a batch found."""

    clean_rows: int
    rejects: dict[str, int]
    duplicates: int
    insert_seconds: float
    check_seconds: float


@dataclass
class Merged:
    """What merging a batch did."""

    updated: int
    inserted: int
    main_rows: int
    match_seconds: float
    write_seconds: float
    months: set[str] = field(default_factory=set)


def clean_batch(lake: Lake, spec: TableSpec, batch: Batch, verify: bool = True) -> Cleaned | None:
    """Deduplicate, type, check and quarantine a landed batch; None when nothing landed.

    All counts are read back from the written files, so a task that ran twice counts once.
    """
    if not lake.has_bronze(spec, batch.ingestion_id):
        log.info("%s: no new data", spec.name)
        return None
    started = batch.clock()
    bronze = lake.bronze_daily(spec, batch.ingestion_id)
    shared = lake.write_changes(spec, "shared", shared_prints(spec, bronze), batch.ingestion_id)
    many = shared.count() > FEW_SHARED
    if many:
        shared = None
    tagged = lake.write_tagged(spec, checked(spec, bronze, batch, shared), batch.ingestion_id)
    insert_seconds = batch.clock() - started

    bad = tagged.filter("is_rejected = 1").drop("is_rejected")
    flagged = quarantine_rows(spec, bad, batch).unionByName(malformed_rows(spec, bronze, batch))

    def check_keys() -> float:
        began = batch.clock()
        if verify:
            assert_unique(lake.daily(spec, batch.ingestion_id), spec.key, f"{spec.name} batch")
        return batch.clock() - began

    rows, duplicates, check_seconds, _ = together(
        [
            lambda: reject_counts(tagged).collect(),
            lambda: duplicate_count(spec, bronze, shared, many).first()[0],
            check_keys,
            lambda: lake.write_quarantine(spec, flagged, batch.ingestion_id),
        ]
    )
    counts = {r["reject_reason"]: r["row_count"] for r in rows}
    clean_rows = counts.pop("clean", 0)
    for reason, n in sorted(counts.items()):
        log.info("%s: %s %d", spec.name, reason, n)
    log.info("%s: clean %d, duplicates %d", spec.name, clean_rows, duplicates)
    return Cleaned(clean_rows, counts, duplicates, insert_seconds, check_seconds)


def _batch_rows(lake: Lake, spec: TableSpec, batch: Batch) -> DataFrame:
    """The clean batch with its carried columns looked up in the orders merged so far."""
    daily = lake.daily(spec, batch.ingestion_id)
    if "order_date" not in spec.carried_names:
        return daily
    held = lake.manifest(ORDERS)
    orders = lake.rows(ORDERS, held).select("order_id", "order_date")
    # Only the orders of this batch go through the lookup; Spark chooses the join by what it reads. A batch with
    # more rows than there are orders asks for most of them, and finding out which costs more than it saves.
    if held.rows > daily.count():
        orders = orders.join(daily.select("order_id").distinct(), "order_id", "left_semi")
    return with_order_date(daily, orders)


def _rows_per_part(
    lake: Lake, spec: TableSpec, changed: DataFrame, found: DataFrame, moved: DataFrame | None, held: Manifest
) -> list:
    """Changed rows by part and action, with the parts that changed and moved rows come from.

    The month can itself be a changed value, so rows leave old months as well as enter new ones. At
    most one group per action and part of the accepted date range.
    """
    place = (lake.month(spec).alias("month"), lake.slot(spec, held.slots).alias("slot"))
    entering = changed.select(*place, "action")
    leave = F.lit("leave").alias("action")
    leaving = found.filter("changed").select(*place, leave)
    if moved is not None:
        leaving = leaving.unionByName(moved.select(F.col("_left").alias("month"), place[1], leave))
    return entering.unionByName(leaving).groupBy("month", "slot", "action").count().collect()


def merge_batch(
    lake: Lake, spec: TableSpec, batch: Batch, verify: bool = True, follows: bool = False
) -> Merged:
    """Merge a clean batch into the main table, rewriting only parts that change.

    Batches of one table merge one after the other; of two that try at once, one fails to commit. With
    ``follows`` other main rows take the date of an order that the run has changed in the same rewrite,
    as ``redate`` would give them before.
    """
    held = lake.manifest(spec)
    moved = _moved(lake, spec, batch, held) if follows else None
    merged = _merge_into(lake, spec, batch, held, verify, moved) if held.number else _first_load(
        lake, spec, batch
    )
    log.info("%s: updated %d, inserted %d", spec.name, merged.updated, merged.inserted)
    return merged


def _first_load(lake: Lake, spec: TableSpec, batch: Batch) -> Merged:
    """Write the first batch straight to the main table."""
    started = batch.clock()
    held = lake.begun(spec, lake.daily(spec, batch.ingestion_id).count())
    rows = merge.first_rows(spec, _batch_rows(lake, spec, batch), batch)
    new = lake.rewrite(spec, lambda part: False, lambda none: rows, held, batch.ingestion_id)
    seconds = batch.clock() - started
    return Merged(0, new.rows, new.rows, 0.0, seconds, {p.month for p in new.parts})


def _merge_into(
    lake: Lake, spec: TableSpec, batch: Batch, held: Manifest, verify: bool, moved: DataFrame | None = None
) -> Merged:
    """Find what changed, write it down, and rewrite the parts it touches.

    The matches and the changes are written tables, so neither the later steps nor a lost executor
    repeat the join with the main table. That join reads rows in force only and moves none of them.
    """
    started = batch.clock()
    daily = _batch_rows(lake, spec, batch)
    large = lake.daily(spec, batch.ingestion_id).count() * LARGE_SHARE > held.rows
    if spec.carried and not large:
        daily = lake.write_changes(spec, "batch", daily, batch.ingestion_id)
    found = lake.write_changes(
        spec, "matches", merge.matches(spec, lake.current(spec, held), daily, fresh=large), batch.ingestion_id
    )
    match_seconds = batch.clock() - started

    started = batch.clock()
    changed = merge.changes(spec, found, daily, batch)
    if moved is not None:
        # A row that the batch overwrites has its date from the orders already.
        still = found.filter("changed").select(*spec.key)
        changed = changed.unionByName(moved.drop("_left").join(still, list(spec.key), "left_anti"))
    changed = lake.write_changes(spec, "changes", changed, batch.ingestion_id)

    def check_keys() -> None:
        # The main table held each key once, so it can only break through the rows written now.
        if verify:
            assert_unique(changed, spec.identity, f"{spec.name} changes")

    groups, _ = together([lambda: _rows_per_part(lake, spec, changed, found, moved, held), check_keys])
    counts: dict[str, int] = {}
    for g in groups:
        counts[g["action"]] = counts.get(g["action"], 0) + g["count"]
    places = {(g["month"], g["slot"]) for g in groups if g["action"] != "close"}
    new = held
    if groups:
        new = lake.rewrite(
            spec, _in(places), lambda old: _replaced(lake, spec, old, changed, held), held, batch.ingestion_id
        )
    seconds = batch.clock() - started
    return Merged(
        sum(counts.get(a, 0) for a in merge.OVERWRITES),
        sum(counts.get(a, 0) for a in merge.ADDS),
        new.rows,
        match_seconds,
        seconds,
        {g["month"] for g in groups},
    )


def _in(places: set[tuple[str, int]]) -> Callable[[Part], bool]:
    """Parts in force that hold a place."""
    return lambda part: part.state == CURRENT and part.place in places


def _replaced(
    lake: Lake, spec: TableSpec, old: DataFrame, changed: DataFrame, held: Manifest
) -> DataFrame:
    """New contents of parts in force, and the rows that end, which only need dealing out."""
    # Parts without any row so far are no bucketed side for the join to follow.
    merged = merge.replaced(spec, old, lake.dealt(spec, changed, held))
    if not spec.history:
        return merged
    names = spec.main_schema().names
    return merged.unionByName(lake.dealt(spec, merge.ended(changed).select(*names), held))


def _months_of_orders(lake: Lake, orders: DataFrame, touched: DataFrame) -> set[str]:
    found = orders.select("order_id", "order_date").join(touched, "order_id", "left_semi")
    return {r[0] for r in found.select(lake.month(ORDERS)).distinct().collect()}


def redate(lake: Lake, spec: TableSpec, batch: Batch) -> int:
    """Give main rows the date of their order, where the run has inserted or moved that order.

    Only rows whose date is another one are written, and only parts that they leave or enter are
    rewritten, so repeating it does nothing. Returns how many rows moved.
    """
    held = lake.manifest(spec)
    moved = _moved(lake, spec, batch, held)
    if moved is None:
        return 0
    # At most one row for each slot and pair of months.
    slot = lake.slot(spec, held.slots).alias("_slot")
    groups = moved.groupBy("_left", lake.month(spec).alias("_entered"), slot).count().collect()
    places = {(g[side], g["_slot"]) for g in groups for side in ("_left", "_entered")}
    if places:
        lake.rewrite(
            spec, _in(places), lambda old: _replaced(lake, spec, old, moved, held), held, batch.ingestion_id
        )
    count = sum(g["count"] for g in groups)
    log.info("%s: %d rows follow their orders", spec.name, count)
    return count


def _moved(lake: Lake, spec: TableSpec, batch: Batch, held: Manifest) -> DataFrame | None:
    """Main rows with another date than their order has, whose order the run has inserted or moved, with that date.

    They come with the month that they leave. An item stands in the month of its order as that was before
    the run, or in none, so only those months are opened. Dates are looked up, so an order with a large
    share of the items is spread over the tasks. None where no row can have moved.
    """
    if "order_date" not in spec.carried_names or not held.number:
        return None
    orders = lake.manifest(ORDERS)
    now = lake.rows(ORDERS, orders)
    # Whatever a run writes to the orders carries its time.
    touched = lake.write_changes(
        spec,
        "touched",
        now.filter(F.col("created_at_silver") == moment(batch.cleaned_at)).select("order_id").distinct(),
        batch.ingestion_id,
    )
    dates = lake.write_changes(
        spec,
        "dates",
        order_dates(now.select("order_id", "order_date").join(touched, "order_id", "left_semi")).select(
            "order_id", F.col("order_date").alias("_date")
        ),
        batch.ingestion_id,
    )
    earlier = lake.manifest(ORDERS, before=batch.ingestion_id)
    months = {p.month for p in held.parts}
    if earlier.number or orders.number == 1:
        # Of an id that several orders share the items have the latest date, one of those found here.
        known = _months_of_orders(lake, lake.rows(ORDERS, earlier), touched) if earlier.number else set()
        months &= known | {UNKNOWN}
    # Otherwise the version before the run is gone, and every month may hold such items.
    if not months:
        return None
    names = spec.main_schema().names
    rows = lake.rows(spec, held, lambda part: part.month in months)
    dated = lookup(rows, dates.withColumn("_touched", F.lit(True)), "order_id", ["_date", "_touched"])
    moved = dated.filter(F.col("_touched") & ~F.col("order_date").eqNullSafe(F.col("_date")))
    moved = moved.withColumn("_left", lake.month(spec)).select(
        *[F.col("_date").alias(n) if n == "order_date" else F.col(n) for n in names],
        "_left",
        F.lit("move").alias("action"),
    )
    return lake.write_changes(spec, "redated", moved, batch.ingestion_id)


def audit_main(lake: Lake, spec: TableSpec) -> None:
    """Check the key rules of a whole main table."""
    if spec.history:
        assert_history(spec, lake.main(spec))
    else:
        assert_unique(lake.main(spec), spec.key, f"{spec.name} main table")


def run_log_row(
    lake: Lake, spec: TableSpec, batch: Batch, cleaned: Cleaned, merged: Merged
) -> DataFrame:
    """The run log entry of one table, built once from everything measured."""
    mine = (F.col("ingestion_id") == batch.ingestion_id) & (F.col("table_name") == spec.name)
    landed = bronze_summary(lake.file_log().filter(mine)).first()
    bronze = landed.asDict() if landed else {}
    silver = {
        "ingestion_id": batch.ingestion_id,
        "table_name": spec.name,
        "silver_daily_row_count": cleaned.clean_rows,
        "silver_main_row_count": merged.main_rows,
        "silver_daily_insert_executing_time": cleaned.insert_seconds,
        "silver_daily_indexing_time": cleaned.check_seconds,
        "silver_main_insert_executing_time": merged.write_seconds,
        "silver_main_update_executing_time": merged.match_seconds,
        "total_silver_process_executing_time": cleaned.insert_seconds
        + cleaned.check_seconds
        + merged.write_seconds
        + merged.match_seconds,
        "silver_daily_null_pk_count": cleaned.rejects.get("missing_pk", 0),
        "silver_daily_required_null_count": cleaned.rejects.get("missing_required_fields", 0),
        "silver_daily_duplicate_count": cleaned.duplicates,
        # NULL where a table has no such rule.
        "silver_daily_future_past_count": cleaned.rejects.get("future_or_past_date", 0)
        if spec.dated
        else None,
        "silver_daily_negative_count": cleaned.rejects.get(spec.negative_label, 0)
        if spec.non_negative
        else None,
        "created_at": batch.cleaned_at,
    }
    return lake.spark.createDataFrame([bronze | silver], RUN_LOG)


def refine(
    lake: Lake,
    spec: TableSpec,
    batch: Batch,
    verify: bool = True,
    followers: Sequence[TableSpec] = (),
    follows: bool = False,
) -> Merged | None:
    """Clean and merge one table's batch and log it. A merged batch is not merged again.

    ``followers`` are tables whose rows take their date from this one once it is merged. A table that is merged
    later in the run can take them with its own batch instead: with ``follows``.
    """
    stage = f"{spec.name}.merged"
    if lake.is_done(batch.ingestion_id, stage):
        log.info("%s: run %d is already merged", spec.name, batch.ingestion_id)
        return None
    with while_writing(lake.spark):
        cleaned = clean_batch(lake, spec, batch, verify)
        if cleaned is None:
            return None
        merged = merge_batch(lake, spec, batch, verify, follows)
        for follower in followers:
            redate(lake, follower, batch)
    lake.write_log(
        "runs", run_log_row(lake, spec, batch, cleaned, merged), spec.name, batch.ingestion_id
    )
    lake.mark_done(batch, stage)
    return merged
