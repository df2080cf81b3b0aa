"""Main tables in buckets and parts: what a merge reads, moves and writes, and what two writers may do."""

import contextlib
import datetime as dt

import pytest
from pyspark.sql import functions as F

from support import day_batch, rows
from tidemark.operators import merge
from tidemark.plans.silver import audit_main, clean_batch, merge_batch, redate, refine
from tidemark.retail import CUSTOMERS, ORDER_ITEMS, ORDERS, PRODUCTS
from tidemark.sources.store import CLOSED, CURRENT, Lake
from test_store import land

DAYS = [day_batch(n, f"2024-01-0{n}") for n in range(1, 6)]


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


@contextlib.contextmanager
def settings(spark, **values):
    names = {k.replace("_", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("partitions", ["4", "64"])
def test_no_row_of_the_main_table_moves_for_a_large_batch(spark, lake, partitions):
    land(lake, ORDERS, [(f"o{i}", "c", f"2020-0{i % 9 + 1}-05", "s") for i in range(300)], DAYS[0])
    refine(lake, ORDERS, DAYS[0])
    land(lake, ORDERS, [(f"o{i}", "c", f"2020-0{i % 9 + 1}-05", "t") for i in range(200, 400)], DAYS[1])
    with settings(spark, spark_sql_autoBroadcastJoinThreshold="-1", spark_sql_shuffle_partitions=partitions):
        refine(lake, ORDERS, DAYS[1])
        held, daily = lake.manifest(ORDERS), lake.daily(ORDERS, 2)
        current = lake.current(ORDERS, held)
        found = merge.matches(ORDERS, current, daily)
        changed = lake.write_changes(ORDERS, "again", merge.changes(ORDERS, found, daily, DAYS[1]), 2)
        for df in (found, merge.replaced(ORDERS, current, changed), merge.replaced(ORDERS, current, lake.dealt(ORDERS, changed, held))):
            # The batch's own, and no other.
            assert plan(df).count("Exchange") == 1 and "Bucketed: true" in plan(df)
        # The same join of rows that lie in no buckets moves them.
        loose = spark.read.schema(current.schema).parquet(*current.inputFiles())
        assert plan(merge.matches(ORDERS, loose, daily)).count("Exchange") == 2
    assert lake.main(ORDERS).count() == held.rows == 400
    assert sum(r.status == "t" for r in lake.main(ORDERS).collect()) == 200


def test_a_merge_opens_rows_in_force_only(lake):
    for n, name in enumerate("abcd"):
        land(lake, CUSTOMERS, [(f"c{i}", name, "2020-01-01") for i in range(8)], DAYS[n])
        refine(lake, CUSTOMERS, DAYS[n])
    held = lake.manifest(CUSTOMERS)
    assert {p.state for p in held.parts} == {CURRENT, CLOSED} and held.rows == 8
    assert sum(p.rows for p in held.parts) == lake.main(CUSTOMERS).count() == 32
    # Rows that ended were written once, by the merge that ended them, and are not opened again.
    assert sorted({p.version.split("-")[0] for p in held.parts if p.state == CLOSED}) == ["2", "3", "4"]
    current = lake.current(CUSTOMERS, held)
    assert all("state=current" in f for f in current.inputFiles())
    assert "state=closed" not in plan(merge.matches(CUSTOMERS, current, lake.daily(CUSTOMERS, 4)))
    audit_main(lake, CUSTOMERS)


def test_one_change_rewrites_one_slot(lake):
    land(lake, PRODUCTS, [(f"p{i}", "n", "c", "1") for i in range(40)], DAYS[0])
    refine(lake, PRODUCTS, DAYS[0])
    assert len(lake.manifest(PRODUCTS).parts) == PRODUCTS.slots
    land(lake, PRODUCTS, [("p7", "n", "c", "2")], DAYS[1])
    refine(lake, PRODUCTS, DAYS[1])
    versions = [p.version.split("-")[0] for p in lake.manifest(PRODUCTS).parts]
    assert sorted(versions) == ["1"] * (PRODUCTS.slots - 1) + ["2"]
    assert rows(lake.main(PRODUCTS).filter("price = 2"), "product_id") == [("p7",)]
    audit_main(lake, PRODUCTS)


def test_of_two_interleaved_writers_one_commits_and_nothing_of_it_is_touched(spark, lake):
    land(lake, PRODUCTS, [("p1", "n", "c", "1"), ("p2", "n", "c", "1")], DAYS[0])
    refine(lake, PRODUCTS, DAYS[0])
    other = Lake(spark, lake.root)
    held = lake.manifest(PRODUCTS)
    price = lambda n: lambda old: old.withColumn("price", F.lit(n).cast("decimal(10,2)"))

    def overtaken(old):
        # The other writer starts from the same version and commits while this one is still writing.
        other.rewrite_months(PRODUCTS, {"all"}, price(5), held)
        return price(7)(old)

    with pytest.raises(Exception, match="exist"):
        lake.rewrite_months(PRODUCTS, {"all"}, overtaken, held)
    for reader in (lake, other, Lake(spark, lake.root)):
        assert rows(reader.main(PRODUCTS).selectExpr("cast(price as int)")) == [(5,), (5,)]
    assert lake.manifest(PRODUCTS)[0] == 2
    # What the loser wrote goes with the old version; the version in force stays.
    assert lake.expire(PRODUCTS, keep=1) == 2 * len(held.parts)
    assert rows(lake.main(PRODUCTS).selectExpr("cast(price as int)")) == [(5,), (5,)]
    # The overtaken run merges again from the version now in force.
    land(lake, PRODUCTS, [("p1", "n", "c", "7")], DAYS[1])
    assert refine(lake, PRODUCTS, DAYS[1]).updated == 1


def test_a_manifest_that_is_being_written_is_not_in_force_yet(lake):
    land(lake, PRODUCTS, [("p1", "n", "c", "1")], DAYS[0])
    refine(lake, PRODUCTS, DAYS[0])
    lake.files.create_text(f"{lake.root}/silver/products/manifest/000000002.json", "")
    assert lake.manifest(PRODUCTS)[0] == 1 and lake.main(PRODUCTS).count() == 1


def test_only_months_of_touched_orders_are_opened_for_new_dates(spark, lake, monkeypatch):
    """An order with a third of the items moves, one arrives late; items of ten other months stay closed."""
    months = [f"2020-{m:02d}-05" for m in range(1, 11)]
    land(lake, ORDERS, [(f"o{m}", "c", d, "s") for m, d in enumerate(months)] + [("o3", "d", "2020-02-07", "s")], DAYS[0])
    refine(lake, ORDERS, DAYS[0])
    items = [(f"o{m}", f"p{i}", "1", "2", "2") for m in range(10) for i in range(3)]
    items += [("o3", f"q{i}", "1", "2", "2") for i in range(20)] + [("late", "p", "1", "2", "2")]
    land(lake, ORDER_ITEMS, items, DAYS[0])
    refine(lake, ORDER_ITEMS, DAYS[0])
    before = lake.manifest(ORDER_ITEMS)
    opened = []
    read = Lake.rows

    def watched(self, spec, held, wanted=None):
        if spec is ORDER_ITEMS:
            opened.append({p.month for p in held.parts if wanted is None or wanted(p)})
        return read(self, spec, held, wanted)

    monkeypatch.setattr(Lake, "rows", watched)
    land(lake, ORDERS, [("o3", "c", "2021-06-01", "s"), ("late", "c", "2021-07-01", "s"), ("o5", "c", months[5], "t")], DAYS[1])
    refine(lake, ORDERS, DAYS[1], followers=[ORDER_ITEMS])
    # Two orders share the id o3, so its items had the later date, of April; those of o5 stay where they are.
    assert opened[0] == {"2020-04", "2020-06", "unknown"} | ({"2020-02"} & {p.month for p in before.parts})
    monkeypatch.undo()
    dates = {r[0]: str(r[1]) for r in lake.main(ORDER_ITEMS).select("order_id", "order_date").distinct().collect()}
    assert dates == {f"o{m}": d for m, d in enumerate(months)} | {"o3": "2021-06-01", "late": "2021-07-01"}
    after = lake.manifest(ORDER_ITEMS)
    assert {p for p in before.parts if p.month not in opened[0]} <= set(after.parts)
    assert redate(lake, ORDER_ITEMS, DAYS[1]) == 0 and lake.manifest(ORDER_ITEMS)[0] == after[0]
    audit_main(lake, ORDER_ITEMS)


def test_a_run_that_dies_between_its_merge_and_the_new_dates_can_be_repeated(lake):
    land(lake, ORDERS, [("o1", "c", "2020-01-05", "s")], DAYS[0])
    land(lake, ORDER_ITEMS, [("o1", "p", "1", "1", "1")], DAYS[0])
    refine(lake, ORDERS, DAYS[0])
    refine(lake, ORDER_ITEMS, DAYS[0])
    land(lake, ORDERS, [("o1", "c", "2020-03-05", "s")], DAYS[1])
    clean_batch(lake, ORDERS, DAYS[1])
    merge_batch(lake, ORDERS, DAYS[1])
    refine(lake, ORDERS, DAYS[1], followers=[ORDER_ITEMS])
    assert rows(lake.main(ORDER_ITEMS), "order_date") == [(dt.date(2020, 3, 5),)]


def test_counts_of_a_version_are_those_of_its_rows(lake):
    for n in range(3):
        land(lake, ORDERS, [(f"o{i}", "c", f"2020-0{(i + n) % 3 + 1}-05", "s") for i in range(n, n + 9)], DAYS[n])
        merged = refine(lake, ORDERS, DAYS[n])
        assert merged.main_rows == lake.main(ORDERS).count() == 9 + n
    per_month = {r["m"]: r["count"] for r in lake.main(ORDERS).groupBy(lake.month(ORDERS).alias("m")).count().collect()}
    counted = {}
    for p in lake.manifest(ORDERS).parts:
        counted[p.month] = counted.get(p.month, 0) + p.rows
    assert counted == per_month
