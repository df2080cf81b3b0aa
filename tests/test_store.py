import datetime as dt

import pytest

from support import bronze, day_batch, rows
from tidemark.operators.quality import KeyViolation
from tidemark.plans.run import refine_all, run
from tidemark.plans.silver import audit_main, clean_batch, merge_batch, redate, refine
from tidemark.retail import CUSTOMERS, ORDER_ITEMS, ORDERS, PRODUCTS
from tidemark.sources.layers import (
    NAMESPACES,
    create_namespaces,
    drop_layer,
    reset_layer,
)
from tidemark.sources.store import Lake
from tidemark.spec import MALFORMED
from tidemark.streaming.incremental import catch_up

DAY1, DAY2 = day_batch(1, "2024-01-01"), day_batch(2, "2024-01-02")


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def land(lake, spec, data, batch):
    frame = bronze(lake.spark, spec, data, str(batch.loaded_at))
    frame = frame.selectExpr(*spec.names, f"cast(null as string) as {MALFORMED}",
                             "created_at_bronze", "source_file_id")
    lake.write_bronze(spec, frame, batch.ingestion_id)


def test_only_months_with_changes_are_rewritten_and_rows_can_move(lake):
    land(lake, ORDERS, [("o1", "c", "2020-01-05", "s"), ("o2", "c", "2020-02-05", "s"),
                        ("o3", "c", "2020-03-05", "s"), ("o4", "c", "2020-01-06", "s")], DAY1)
    first = refine(lake, ORDERS, DAY1)
    assert (first.updated, first.inserted, first.main_rows) == (0, 4, 4)
    assert lake.manifest(ORDERS) == (1, {"2020-01": "1", "2020-02": "1", "2020-03": "1"})

    land(lake, ORDERS, [("o2", "c", "2020-04-01", "s"), ("o4", "c", "2020-01-06", "t")], DAY2)
    second = refine(lake, ORDERS, DAY2)
    assert (second.updated, second.inserted, second.main_rows) == (2, 0, 4)
    assert second.months == {"2020-01", "2020-02", "2020-04"}
    # February lost its only row, March was not touched.
    assert lake.manifest(ORDERS) == (2, {"2020-01": "2", "2020-03": "1", "2020-04": "2"})
    assert rows(lake.main(ORDERS), "order_id", "status") == [
        ("o1", "s"), ("o2", "s"), ("o3", "s"), ("o4", "t"),
    ]
    audit_main(lake, ORDERS)

    between = lake.main_between(ORDERS, dt.date(2020, 1, 6), dt.date(2020, 3, 31))
    assert rows(between, "order_id") == [("o3",), ("o4",)]
    assert len({f.split("/month=")[1][:7] for f in between.inputFiles()}) == 2


def test_old_versions_can_be_dropped(lake):
    for n, price in enumerate("123", start=1):
        day = day_batch(n, f"2024-01-0{n}")
        land(lake, ORDERS, [("o1", "c", "2020-01-05", price), ("o2", "c", "2020-02-05", "s")], day)
        refine(lake, ORDERS, day)
        lake.drop_staging(ORDERS, n)
    assert lake.manifest(ORDERS) == (3, {"2020-01": "3", "2020-02": "1"})
    assert lake.expire(ORDERS, keep=1) == 2
    assert lake.expire(ORDERS, keep=1) == 0
    assert rows(lake.main(ORDERS), "order_id", "status") == [("o1", "3"), ("o2", "s")]
    assert lake.manifest(ORDERS)[0] == 3


def test_a_merged_run_is_not_merged_again_and_a_broken_one_can_be_repeated(lake):
    land(lake, PRODUCTS, [("p1", "n", "c", "1")], DAY1)
    refine(lake, PRODUCTS, DAY1)
    assert refine(lake, PRODUCTS, DAY1) is None
    land(lake, PRODUCTS, [("p1", "n", "c", "2"), ("p2", "n", "c", "1")], DAY2)
    # The run dies after its merge, before it is marked as done.
    clean_batch(lake, PRODUCTS, DAY2)
    merge_batch(lake, PRODUCTS, DAY2)
    again = refine(lake, PRODUCTS, DAY2)
    assert (again.updated, again.inserted, again.main_rows) == (0, 0, 2)
    assert lake.manifest(PRODUCTS)[0] == 2
    assert lake.run_log().count() == 2


def test_a_run_without_changes_writes_no_version(lake):
    land(lake, PRODUCTS, [("p1", "n", "c", "1")], DAY1)
    refine(lake, PRODUCTS, DAY1)
    land(lake, PRODUCTS, [("P1", "N", "c", "1.00")], DAY2)
    assert refine(lake, PRODUCTS, DAY2).months == set()
    assert lake.manifest(PRODUCTS)[0] == 1


def test_two_merges_at_once_cannot_both_commit(lake):
    land(lake, PRODUCTS, [("p1", "n", "c", "1")], DAY1)
    refine(lake, PRODUCTS, DAY1)
    held = lake.manifest(PRODUCTS)
    lake.rewrite_months(PRODUCTS, {"all"}, lambda old: old, held)
    with pytest.raises(Exception, match="exist"):
        lake.rewrite_months(PRODUCTS, {"all"}, lambda old: old, held)


def test_history_through_the_store(lake):
    land(lake, CUSTOMERS, [("c1", "a", "2020-01-01"), ("c2", "b", "2020-01-01")], DAY1)
    refine(lake, CUSTOMERS, DAY1)
    land(lake, CUSTOMERS, [("c1", "x", "2020-01-01"), ("c3", "c", "2020-01-01")], DAY2)
    second = refine(lake, CUSTOMERS, DAY2)
    assert (second.updated, second.inserted, second.main_rows) == (1, 2, 3)
    assert rows(lake.main(CUSTOMERS), "customer_id", "name", "is_valid") == [
        ("c1", "a", False), ("c1", "x", True), ("c2", "b", True), ("c3", "c", True),
    ]
    audit_main(lake, CUSTOMERS)
    log = lake.run_log().filter("ingestion_id = 2").first()
    assert log.silver_daily_row_count == 2 and log.silver_main_row_count == 3
    assert log.silver_daily_negative_count is None and log.silver_daily_future_past_count == 0
    assert log.total_silver_process_executing_time > 0


def test_order_items_take_their_order_date_from_merged_orders(lake):
    land(lake, ORDERS, [("o1", "c", "2020-01-05", "s")], DAY1)
    land(lake, ORDER_ITEMS, [("o1", "p", "1", "1", "1"), ("o9", "p", "1", "1", "1")], DAY1)
    done = refine_all(lake, DAY1, {"order_items": ORDER_ITEMS, "orders": ORDERS}, parallel=True)
    assert list(done) == ["orders", "order_items"]
    assert rows(lake.main(ORDER_ITEMS), "order_id", "order_date") == [
        ("o1", dt.date(2020, 1, 5)), ("o9", None),
    ]
    assert set(lake.manifest(ORDER_ITEMS)[1]) == {"2020-01", "unknown"}
    # The order of o9 arrives, and the item changes: it moves to its month.
    land(lake, ORDERS, [("o9", "c", "2020-02-01", "s")], DAY2)
    land(lake, ORDER_ITEMS, [("o9", "p", "2", "1", "2")], DAY2)
    refine_all(lake, DAY2, {"orders": ORDERS, "order_items": ORDER_ITEMS})
    assert set(lake.manifest(ORDER_ITEMS)[1]) == {"2020-01", "2020-02"}
    audit_main(lake, ORDER_ITEMS)


def test_quarantine_of_a_repeated_run_is_replaced(lake):
    land(lake, PRODUCTS, [("p1", "n", "c", "-1"), ("p2", "n", "c", "1")], DAY1)
    assert lake.quarantine().count() == 0
    for _ in range(2):
        cleaned = clean_batch(lake, PRODUCTS, DAY1)
    assert cleaned.rejects == {"negative_price": 1} and cleaned.clean_rows == 1
    assert rows(lake.quarantine(), "ingestion_id", "table_name", "reject_reason") == [
        (1, "products", "negative_price")
    ]


def test_a_broken_main_table_is_found(lake):
    land(lake, PRODUCTS, [("p1", "n", "c", "1")], DAY1)
    refine(lake, PRODUCTS, DAY1)
    lake.rewrite_months(PRODUCTS, {"all"}, lambda old: old.union(old), lake.manifest(PRODUCTS))
    with pytest.raises(KeyViolation):
        audit_main(lake, PRODUCTS)


def test_tables_without_landing_files_are_skipped(lake, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "products_1.csv").write_text("product_id,name,category,price\nP1,n,c,1\n")
    done = run(lake, str(landing), DAY1, {"products": PRODUCTS, "orders": ORDERS})
    assert done["orders"] is None and done["products"].inserted == 1


def test_incremental_runs_take_each_file_once(lake, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    header = "product_id,name,category,price\n"

    def catch(batch):
        catch_up(lake, [PRODUCTS], str(landing), lambda epoch: batch, str(tmp_path / "seen"))

    (landing / "products_1.csv").write_text(header + "P1,n,c,1\nP2,n\n")
    (landing / "orders_1.csv").write_text("other\n")
    catch(DAY1)
    assert rows(lake.main(PRODUCTS), "product_id") == [("p1",)]
    assert rows(lake.quarantine(), "reject_reason") == [("malformed_row",)]
    (landing / "products_2.csv").write_text(header + "P1,n,c,2\nP3,n,c,1\n")
    catch(DAY2)
    catch(day_batch(3, "2024-01-03"))
    assert rows(lake.main(PRODUCTS).selectExpr("product_id", "cast(price as int)")) == [
        ("p1", 2), ("p3", 1),
    ]
    assert not lake.has_bronze(PRODUCTS, 3)
    assert rows(lake.bronze(PRODUCTS), "source_file_id") == [
        ("1/products_1.csv",), ("1/products_1.csv",), ("2/products_2.csv",), ("2/products_2.csv",),
    ]


def test_catalog_layers(spark):
    create_namespaces(spark)
    assert set(NAMESPACES) <= {d.name for d in spark.catalog.listDatabases()}
    one = {"customers": CUSTOMERS}
    assert reset_layer(spark, "silver_main", one) == ["silver.customers"]
    assert reset_layer(spark, "silver_main", one) == ["silver.customers"]
    assert spark.table("silver.customers").schema.names == CUSTOMERS.main_schema().names
    assert spark.table("silver.customers").count() == 0
    drop_layer(spark, "silver_main", one)
    assert not spark.catalog.tableExists("silver.customers")


def test_items_follow_the_dates_of_their_orders(lake):
    items = lambda *ids: [(o, "p", "1", "2", "2") for o in ids]
    land(lake, ORDERS, [("o1", "c", "2020-01-05", "s"), ("o2", "c", "2020-02-05", "s")], DAY1)
    land(lake, ORDER_ITEMS, items("o1", "o2", "o3"), DAY1)
    chain = {s.name: s for s in (ORDERS, ORDER_ITEMS)}
    refine_all(lake, DAY1, chain)
    dates = lambda: {r.order_id: str(r.order_date) for r in lake.main(ORDER_ITEMS).collect()}
    assert dates() == {"o1": "2020-01-05", "o2": "2020-02-05", "o3": "None"}
    # One order arrives late and one moves; their items come again unchanged, or not at all.
    land(lake, ORDERS, [("o3", "c", "2021-03-01", "s"), ("o1", "c", "2021-04-01", "s"), ("o2", "c", "2020-02-05", "t")], DAY2)
    land(lake, ORDER_ITEMS, items("o3"), DAY2)
    refine_all(lake, DAY2, chain)
    assert dates() == {"o1": "2021-04-01", "o2": "2020-02-05", "o3": "2021-03-01"}
    between = lake.main_between(ORDER_ITEMS, dt.date(2021, 1, 1), dt.date(2021, 12, 31))
    assert rows(between, "order_id") == [("o1",), ("o3",)]
    assert set(lake.manifest(ORDER_ITEMS)[1]) == {"2020-02", "2021-03", "2021-04"}
    version = lake.manifest(ORDER_ITEMS)[0]
    assert redate(lake, ORDER_ITEMS, DAY2) == 0 and lake.manifest(ORDER_ITEMS)[0] == version
    audit_main(lake, ORDER_ITEMS)
