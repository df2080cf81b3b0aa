"""One stream over all tables, the given clock, and the catalog's names."""

import dataclasses
import itertools
import threading

import pytest

from support import day_batch, rows
from tidemark.plans import run as whole_run
from tidemark.plans.run import run
from tidemark.retail import ORDER_ITEMS, ORDERS, PRODUCTS
from tidemark.sources.layers import publish
from tidemark.sources.store import Lake
from tidemark.streaming import incremental
from tidemark.streaming.incremental import follow

DAY1, DAY2 = day_batch(1, "2024-01-01"), day_batch(2, "2024-01-02")
CHOSEN = {s.name: s for s in (ORDER_ITEMS, ORDERS)}
ORDER_HEAD, ITEM_HEAD = "order_id,customer_id,order_date,status\n", "order_id,product_id,quantity,unit_price,total\n"


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    return folder


def test_one_stream_takes_the_files_of_all_tables_once_and_orders_first(lake, landing, tmp_path):
    def catch(batch):
        follow(lake, str(landing), lambda epoch: batch, str(tmp_path / "seen"), specs=CHOSEN).awaitTermination()

    (landing / "order_items_1.csv").write_text(ITEM_HEAD + "o1,p,1,2,2\no2,p,1,2,2\n")
    (landing / "orders_1.csv").write_text(ORDER_HEAD + "o1,c,2020-01-05,s\n")
    (landing / "notes_1.csv").write_text("other\n")
    catch(DAY1)
    day = lambda: rows(lake.main(ORDER_ITEMS).selectExpr("order_id", "cast(order_date as string)"))
    assert day() == [("o1", "2020-01-05"), ("o2", None)]
    assert rows(lake.registry(), "file_name", "table_name", "ingestion_id") == [
        ("notes_1.csv", None, 1), ("order_items_1.csv", "order_items", 1), ("orders_1.csv", "orders", 1),
    ]
    (landing / "orders_2.csv").write_text(ORDER_HEAD + "o2,c,2020-02-05,s\n")
    catch(DAY2)
    assert day() == [("o1", "2020-01-05"), ("o2", "2020-02-05")]
    assert rows(lake.registry().filter("ingestion_id = 2"), "file_name") == [("orders_2.csv",)]
    catch(day_batch(3, "2024-01-03"))
    assert not lake.has_registry(3)


def test_a_micro_batch_that_failed_is_taken_again_whole_and_once(lake, landing, tmp_path, monkeypatch):
    (landing / "orders_1.csv").write_text(ORDER_HEAD + "o1,c,2020-01-05,s\n")
    start = lambda: follow(lake, str(landing), lambda epoch: DAY1, str(tmp_path / "seen"), specs=CHOSEN)

    def broken(*args, **kwargs):
        run(*args, **kwargs)
        raise OSError("lost after the merge")

    monkeypatch.setattr(incremental, "run", broken)
    with pytest.raises(Exception, match="lost"):
        start().awaitTermination()
    monkeypatch.undo()
    # A file that arrives in between belongs to the next micro-batch.
    (landing / "orders_2.csv").write_text(ORDER_HEAD + "o2,c,2020-01-06,s\n")
    with pytest.raises(Exception, match="needs a run of its own"):
        start().awaitTermination()
    assert rows(lake.main(ORDERS), "order_id") == [("o1",)]
    assert lake.run_log().count() == 1 and lake.manifest(ORDERS)[0] == 1
    query = follow(lake, str(landing), {0: DAY1, 1: DAY2}.get, str(tmp_path / "seen"), specs=CHOSEN)
    query.awaitTermination()
    assert rows(lake.main(ORDERS), "order_id") == [("o1",), ("o2",)]


def test_timings_follow_the_given_clock(lake, landing):
    """Each thread's clock goes on by one whenever it is read, so every step takes one second."""
    own = threading.local()

    def tick() -> float:
        own.time = getattr(own, "time", None) or itertools.count()
        return float(next(own.time))

    (landing / "products_1.csv").write_text("product_id,name,category,price\nP1,n,c,1\n")
    batch = dataclasses.replace(DAY1, clock=tick)
    run(lake, str(landing), batch, {"products": PRODUCTS})
    log = lake.run_log().first()
    assert log.bronze_daily_copy_executing_time == log.total_bronze_process_executing_time == 1.0
    assert log.silver_daily_insert_executing_time == log.silver_daily_indexing_time == 1.0
    assert (log.silver_main_update_executing_time, log.silver_main_insert_executing_time) == (0.0, 1.0)
    assert log.total_silver_process_executing_time == 3.0


def test_names_in_the_catalog_follow_the_version_in_force(spark, lake, landing):
    header = "product_id,name,category,price\n"
    (landing / "products_1.csv").write_text(header + "P1,n,c,1\nP2,n,c,-1\n")
    run(lake, str(landing), DAY1, {"products": PRODUCTS}, catalog=True)
    price = lambda: rows(spark.table("silver.products").selectExpr("product_id", "cast(price as int)"))
    assert price() == [("p1", 1)] and spark.table("silver.products").columns == PRODUCTS.main_schema().names
    assert spark.table("bronze.products_raw").filter("ingestion_id = 1").count() == 2
    assert rows(spark.table("operational_log.quarantine"), "reject_reason", "table_name") == [("negative_price", "products")]
    (landing / "products_2.csv").write_text(header + "P1,n,c,5\n")
    whole_run.run(lake, str(landing), DAY2, {"products": PRODUCTS})
    assert price() == [("p1", 1)]
    assert "silver.products" in publish(lake, {"products": PRODUCTS})
    assert price() == [("p1", 5)] and spark.table("bronze.products_raw").count() == 3
