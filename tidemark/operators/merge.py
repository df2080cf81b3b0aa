"""Merging a clean batch into a main table, in place or with history.

Both sides hold a key at most once (the batch after deduplication, the main table by its own rule),
so no join below can meet a hot key.

Two routes give the same rows:

* ``upsert_actions`` / ``history_actions`` tell what happens to every row of the main table, from one
  full outer join. They suit frames that are not stored, each of which they evaluate once; ``merge`` is
  this route.
* ``matches`` -> ``changes`` -> ``replaced`` find what changed with an inner join and put it in place.
  Where the main table is in buckets of its key, as in the store, no row of it moves, whatever the size
  of the batch, and only the parts that hold a change are rewritten.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column as Col
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import moment
from tidemark.spec import Batch, TableSpec

# Actions that put new contents in the place of a main row, and actions that add a row.
OVERWRITES = ("update", "close", "replace")
ADDS = ("insert", "open")

OPEN_END = dt.datetime(2050, 1, 1)


def _day(batch: Batch) -> dt.datetime:
    return dt.datetime.combine(batch.as_of, dt.time())


def _opened_today(batch: Batch, changed: Col) -> Col:
    """Whether a changed row's current version is of the batch's day.

    A batch older than a version that it would change is refused: history is written in date order.
    """
    day = moment(_day(batch))
    late = F.concat(F.lit(f"batch of {batch.as_of} would change the newer version of "), F.col("valid_from").cast("string"))
    return (
        F.when(~changed, F.lit(False))
        .when(F.col("valid_from") > day, F.raise_error(late).cast("boolean"))
        .otherwise(F.col("valid_from") == day)
    )


def _new(name: str) -> Col:
    return F.col(f"_new_{name}")


def _renamed(spec: TableSpec, daily: DataFrame) -> DataFrame:
    """The batch with its non-key columns prefixed, ready to stand beside a main row."""
    return daily.select(
        *spec.key,
        *[F.col(c).alias(f"_new_{c}") for c in spec.payload + ("created_at_bronze",)],
        *[
            (F.col(c.name) if c.name in daily.columns else F.lit(None).cast(c.silver_type)).alias(
                f"_new_{c.name}"
            )
            for c in spec.carried
        ],
    )


def _differs(spec: TableSpec) -> Col:
    """Null-safe row inequality of the compared columns."""
    old = F.struct(*[F.col(c) for c in spec.payload])
    new = F.struct(*[_new(c).alias(c) for c in spec.payload])
    return ~old.eqNullSafe(new)


def _main_names(spec: TableSpec) -> list[str]:
    return [f.name for f in spec.main_schema()]


def _written(spec: TableSpec, values: dict[str, Col]) -> list[Col]:
    """A main row in schema order; columns not given keep their name."""
    return [values.get(n, F.col(n)).alias(n) for n in _main_names(spec)]


def _from_batch(spec: TableSpec, batch: Batch) -> dict[str, Col]:
    values = {c: _new(c) for c in spec.payload + spec.carried_names + ("created_at_bronze",)}
    return values | {"created_at_silver": moment(batch.cleaned_at)}


def _updated_row(spec: TableSpec, batch: Batch) -> list[Col]:
    """Main row with the batch's payload; carried values stay where the batch has none."""
    carried = {c: F.coalesce(_new(c), F.col(c)) for c in spec.carried_names}
    return _written(spec, _from_batch(spec, batch) | carried)


def _inserted_row(spec: TableSpec, batch: Batch) -> list[Col]:
    version = {
        "valid_from": moment(_day(batch)),
        "valid_to": moment(OPEN_END),
        "is_valid": F.lit(True),
    }
    return _written(spec, _from_batch(spec, batch) | version)


def _kept_row(spec: TableSpec) -> list[Col]:
    return [F.col(n) for n in _main_names(spec)]


def _closed_row(spec: TableSpec, batch: Batch) -> list[Col]:
    ended = moment(_day(batch) - dt.timedelta(days=1))
    return _written(spec, {"valid_to": ended, "is_valid": F.lit(False)})


def _row(columns: list[Col], action: str) -> Col:
    """A main row and what happened to it, as one struct."""
    return F.struct(*columns, F.lit(action).alias("action"))


# ---- whole-table route -----------------------------------------------------------------------


def _side_by_side(spec: TableSpec, main: DataFrame, daily: DataFrame) -> DataFrame:
    kept = main.select(*_kept_row(spec), F.lit(True).alias("_in_main"))
    batch = _renamed(spec, daily).withColumn("_in_batch", F.lit(True))
    return kept.join(batch, list(spec.key), "full_outer")


def upsert_actions(
    spec: TableSpec, main: DataFrame, daily: DataFrame, batch: Batch
) -> DataFrame:
    """The merged table with an ``action`` per row: keep, update or insert."""
    both = _side_by_side(spec, main, daily)
    row = (
        F.when(F.col("_in_main").isNull(), _row(_inserted_row(spec, batch), "insert"))
        .when(
            F.col("_in_batch") & _differs(spec),
            _row(_updated_row(spec, batch), "update"),
        )
        .otherwise(_row(_kept_row(spec), "keep"))
    )
    return both.select(row.alias("r")).select("r.*")


def upsert(spec: TableSpec, main: DataFrame, daily: DataFrame, batch: Batch) -> DataFrame:
    """Overwrite changed rows, add new ones, leave the rest alone."""
    return upsert_actions(spec, main, daily, batch).drop("action")


def history_actions(
    spec: TableSpec, main: DataFrame, daily: DataFrame, batch: Batch
) -> DataFrame:
    """The history table after a batch, with an ``action`` per row: keep, close, open or replace.

    A row opened today that changes again today is replaced, so no version gets an end before its
    start.
    """
    both = _side_by_side(spec, main.filter("is_valid"), daily)
    kept = _row(_kept_row(spec), "keep")
    opened = _row(_inserted_row(spec, batch), "open")
    changed = F.col("_in_batch") & _differs(spec)
    opened_today = _opened_today(batch, F.coalesce(changed, F.lit(False)))
    rows = (
        F.when(F.col("_in_main").isNull(), F.array(opened))
        .when(
            opened_today, F.array(_row(_updated_row(spec, batch), "replace"))
        )
        .when(changed, F.array(_row(_closed_row(spec, batch), "close"), opened))
        .otherwise(F.array(kept))
    )
    past = main.filter("not is_valid").select(*_kept_row(spec), F.lit("keep").alias("action"))
    return both.select(F.explode(rows).alias("r")).select("r.*").unionByName(past)


def upsert_history(spec: TableSpec, main: DataFrame, daily: DataFrame, batch: Batch) -> DataFrame:
    """Close changed current rows and open a new version for every new or changed key."""
    return history_actions(spec, main, daily, batch).drop("action")


def merge(spec: TableSpec, main: DataFrame, daily: DataFrame, batch: Batch) -> DataFrame:
    return (upsert_history if spec.history else upsert)(spec, main, daily, batch)


def action_counts(actions: DataFrame) -> DataFrame:
    """One row: rows updated (closed or replaced), inserted (opened) and left as they were."""
    action = F.col("action")
    return actions.agg(
        F.count_if(action.isin(*OVERWRITES)).alias("updated"),
        F.count_if(action.isin(*ADDS)).alias("inserted"),
        F.count_if(action == "keep").alias("kept"),
    )


def current(history: DataFrame) -> DataFrame:
    return history.filter("is_valid")


# ---- change-set route ------------------------------------------------------------------------


def matches(spec: TableSpec, main: DataFrame, daily: DataFrame, fresh: bool = False) -> DataFrame:
    """Main rows whose key is in the batch, beside the batch's values; ``changed`` tells if they differ.

    Never more rows than the batch. No join hint: Spark broadcasts the batch when its size allows and
    otherwise sorts both sides by key.

    With ``fresh`` the batch's other rows are there, too, ``_held`` NULL, so that ``changes`` needs no second join
    to find them. Spark can't broadcast the batch then, so this is for batches that are no small part of the table.
    """
    if spec.history:
        held = main.filter("is_valid").select(*_kept_row(spec))
    else:
        held = main.select(*spec.names, *spec.carried_names)
    if fresh:
        both = held.withColumn("_held", F.lit(True)).join(_renamed(spec, daily), list(spec.key), "right")
        return both.withColumn("changed", F.col("_held").isNotNull() & _differs(spec))
    return (
        held.join(_renamed(spec, daily), list(spec.key), "inner")
        .withColumn("changed", _differs(spec))
    )


def update_set(spec: TableSpec, main: DataFrame, daily: DataFrame, batch: Batch) -> DataFrame:
    """New contents of the main rows a batch changes."""
    return (
        matches(spec, main, daily).filter("changed").select(*_updated_row(spec, batch))
    )


def insert_set(spec: TableSpec, main: DataFrame, daily: DataFrame, batch: Batch) -> DataFrame:
    """Batch rows whose key the main table (its current rows, for history) does not hold."""
    held = main.filter("is_valid") if spec.history else main
    fresh = daily.join(held.select(*spec.key), list(spec.key), "left_anti")
    return _renamed(spec, fresh).select(*_inserted_row(spec, batch))


def close_set(spec: TableSpec, main: DataFrame, daily: DataFrame, batch: Batch) -> DataFrame:
    """Current history rows that a batch ends, as they look afterwards."""
    return (
        matches(spec, main, daily)
        .filter(F.col("changed") & (F.col("valid_from") < moment(_day(batch))))
        .select(*_closed_row(spec, batch))
    )


def open_set(spec: TableSpec, main: DataFrame, daily: DataFrame, batch: Batch) -> DataFrame:
    """New history rows: batch keys without a valid row once changed rows are closed."""
    found = matches(spec, main, daily)
    replaced = found.filter(_opened_today(batch, F.col("changed")))
    still_held = found.filter(~F.col("changed")).select(*spec.key).unionByName(
        replaced.select(*spec.key)
    )
    fresh = daily.join(still_held, list(spec.key), "left_anti")
    return _renamed(spec, fresh).select(*_inserted_row(spec, batch))


def changes(
    spec: TableSpec, found: DataFrame, daily: DataFrame, batch: Batch
) -> DataFrame:
    """All rows a batch writes, each with its ``action``, given the matches already found.

    ``found`` is ``matches(...)``, best read back from where it was written: it is used twice.
    """
    if "_held" in found.columns:
        fresh = found.filter(F.col("_held").isNull())
    else:
        fresh = _renamed(spec, daily.join(found.select(*spec.key), list(spec.key), "left_anti"))
    inserted = _inserted_row(spec, batch)
    changed = found.filter("changed")
    if not spec.history:
        return changed.select(*_updated_row(spec, batch), F.lit("update").alias("action")).unionByName(
            fresh.select(*inserted, F.lit("insert").alias("action"))
        )
    opened = _row(inserted, "open")
    rows = F.when(
        _opened_today(batch, F.lit(True)),
        F.array(_row(_updated_row(spec, batch), "replace")),
    ).otherwise(F.array(_row(_closed_row(spec, batch), "close"), opened))
    return (
        changed.select(F.explode(rows).alias("r"))
        .select("r.*")
        .unionByName(fresh.select(*inserted, F.lit("open").alias("action")))
    )


def first_rows(spec: TableSpec, daily: DataFrame, batch: Batch) -> DataFrame:
    """The whole main table after its first batch: nothing to compare, every row is new."""
    return _renamed(spec, daily).select(*_inserted_row(spec, batch))


def apply_changes(spec: TableSpec, main: DataFrame, changed: DataFrame) -> DataFrame:
    """Main rows without those a change replaces, plus the changed and new rows."""
    overwritten = changed.filter(F.col("action").isin(*OVERWRITES))
    names = _main_names(spec)
    return (
        main.join(overwritten.select(*spec.identity), list(spec.identity), "left_anti")
        .select(*names)
        .union(changed.select(*names))
    )


def ended(changed: DataFrame) -> DataFrame:
    """The changed rows that are in force no longer."""
    return changed.filter("action = 'close'")


def replaced(spec: TableSpec, rows: DataFrame, changed: DataFrame) -> DataFrame:
    """Rows in force with changed ones in the place of those of the same key, and new ones beside them.

    Both sides hold a key once. One full outer join: rows in buckets of the key stay in their bucket.
    """
    names = _main_names(spec)
    new = changed.filter("action <> 'close'").select(*spec.key, F.struct(*names).alias("_new"))
    old = rows.select(*spec.key, F.struct(*names).alias("_old"))
    both = old.join(new, list(spec.key), "full_outer")
    return both.select(F.coalesce("_new", "_old").alias("r")).select("r.*")
