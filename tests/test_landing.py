import dataclasses

import pytest
from pyspark.sql import functions as F

from support import bronze, day_batch, rows
from tidemark.operators import merge
from tidemark.operators.metrics import DAILY, HISTORY, longest_load, rows_by_run, rows_loaded
from tidemark.operators.quality import checked, clean, malformed_rows, reconciliation
from tidemark.plans.bronze import ingest
from tidemark.plans.run import new_batch
from tidemark.retail import CUSTOMERS, ORDER_ITEMS, ORDERS, PRODUCTS, RETAIL
from tidemark.sources.export import export_csv, preview, write_landing
from tidemark.sources.landing import discover, route, scan, unrouted
from tidemark.sources.store import Lake
from tidemark.streaming.incremental import start

HEADER = "customer_id,name,signup_date\n"


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    return folder


def test_names_route_to_tables(spark):
    names = ["customers_1.csv", "order_items.csv", "orders9.csv", "payments-x.csv", "products_raw.csv",
             "my_orders.csv", "unknown_1.csv"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(route(F.col("n"))).collect()] == [
        "customers", "order_items", "orders", "payments", "products", None, None,
    ]


def test_discovery_reports_strangers_and_skips_other_files_and_folders(spark, landing):
    (landing / "customers_1.csv").write_text(HEADER)
    (landing / "unknown_1.csv").write_text("a\n")
    (landing / "notes.txt").write_text("x")
    (landing / "old").mkdir()
    (landing / "old" / "orders_1.csv").write_text("x")
    files = discover(spark, str(landing))
    assert rows(files, "file_name", "table_name") == [
        ("customers_1.csv", "customers"),
        ("unknown_1.csv", None),
    ]
    assert rows(unrouted(files), "file_name") == [("unknown_1.csv",)]


def test_csv_fields(spark, landing, batch):
    (landing / "customers_1.csv").write_text(
        HEADER + 'c1,"Doe, Jane",2020-01-01\nc2,"",\n"  ","say ""hi""", 2020-01-01 \n'
    )
    frame = scan(spark, CUSTOMERS, str(landing), batch)
    assert rows(frame, *CUSTOMERS.names) == [
        ("  ", 'say "hi"', " 2020-01-01 "),
        ("c1", "Doe, Jane", "2020-01-01"),
        ("c2", None, None),
    ]
    assert rows(frame, "source_file_id")[0] == ("1/customers_1.csv",)
    assert {r.created_at_bronze for r in frame.collect()} == {batch.loaded_at}


def test_short_and_long_rows_go_to_quarantine(spark, landing, batch):
    (landing / "customers_1.csv").write_text(HEADER + "c1,n,2020-01-01\nc2,n\nc3,n,2020-01-01,x\n")
    lake = Lake(spark, str(landing / "lake"))
    lake.write_bronze(CUSTOMERS, scan(spark, CUSTOMERS, str(landing), batch), 1)
    frame = lake.bronze_daily(CUSTOMERS, 1)
    bad = malformed_rows(CUSTOMERS, frame, batch)
    assert {r.reject_reason for r in bad.collect()} == {"malformed_row"}
    assert sorted(r.raw_row.split('"')[3] for r in bad.collect()) == ["c2,n", "c3,n,2020-01-01,x"]
    tagged = checked(CUSTOMERS, frame, batch)
    assert rows(tagged, "customer_id") == [("c1",)]
    assert tuple(reconciliation(CUSTOMERS, frame, tagged).first()) == ("customers", 3, 0, 2, 0, 1)


def test_columns_are_positional_and_a_wrong_header_is_an_error(spark, landing, batch):
    (landing / "customers_1.csv").write_text("name,customer_id,signup_date\nc1,n,2020-01-01\n")
    with pytest.raises(Exception, match="header"):
        scan(spark, CUSTOMERS, str(landing), batch).collect()
    trusted = scan(spark, CUSTOMERS, str(landing), batch, check_header=False)
    assert rows(trusted, "customer_id", "name") == [("c1", "n")]


def test_orders_do_not_take_order_items(spark, landing, batch):
    (landing / "orders_1.csv").write_text("order_id,customer_id,order_date,status\no,c,d,s\n")
    (landing / "order_items_1.csv").write_text("order_id,product_id,quantity,unit_price,total\no,p,1,1,1\n")
    assert scan(spark, ORDERS, str(landing), batch).count() == 1
    assert scan(spark, ORDER_ITEMS, str(landing), batch).count() == 1


def test_ingest_logs_every_file_and_archives_after_success(spark, landing, tmp_path, batch):
    (landing / "customers_1.csv").write_text(HEADER + "c1,n,2020-01-01\nc2,n,2020-01-01\n")
    (landing / "customers_2.csv").write_text(HEADER)
    (landing / "unknown_1.csv").write_text("a\n1\n")
    lake, archive = Lake(spark, str(tmp_path / "lake")), tmp_path / "archive"
    summary = ingest(lake, str(landing), batch, archive=str(archive))
    assert rows(summary, "table_name", "bronze_daily_row_count", "bronze_main_row_count") == [
        ("customers", 2, 2)
    ]
    assert rows(lake.file_log(), "source_file_name", "ingestion_for", "row_count") == [
        ("customers_1.csv", DAILY, 2),
        ("customers_1.csv", HISTORY, 2),
        ("customers_2.csv", DAILY, 0),
        ("customers_2.csv", HISTORY, 0),
    ]
    left = {p.name for p in landing.iterdir() if not p.name.startswith(".")}
    assert left == {"unknown_1.csv"}
    assert {p.name for p in archive.iterdir() if not p.name.startswith(".")} == {
        "1_customers_1.csv", "1_customers_2.csv",
    }
    # A repeated run changes nothing.
    ingest(lake, str(landing), batch)
    assert lake.bronze_daily(CUSTOMERS, 1).count() == 2

    log = lake.file_log()
    assert rows_loaded(log, "customers", 1, DAILY).first()[0] == 2
    assert longest_load(log, "customers", 1, DAILY).first()[0] > 0
    assert rows(rows_by_run(log)) == [("customers", 1, 4)]
    assert not lake.has_bronze(PRODUCTS, 1)


def test_history_keeps_all_runs_and_run_numbers_are_never_reused(spark, landing, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    for day in ("2024-01-01", "2024-01-02"):
        (landing / "customers_1.csv").write_text(HEADER + f"c1,n,{day}\n")
        batch = new_batch(lake, day_batch(0, day).loaded_at)
        ingest(lake, str(landing), batch)
    assert rows(lake.bronze(CUSTOMERS), "ingestion_id", "signup_date") == [
        (1, "2024-01-01"),
        (2, "2024-01-02"),
    ]
    lake.retire_bronze(CUSTOMERS, 1)
    assert rows(lake.bronze(CUSTOMERS), "ingestion_id") == [(2,)]
    assert new_batch(lake, batch.loaded_at).ingestion_id == 3


def test_export_and_preview(spark, tmp_path):
    data = [(f"o{i}", "c", None, f'"{i}", ') for i in range(8)]
    table = spark.createDataFrame(data, ORDERS.landing_schema())
    export_csv(ORDERS, table, str(tmp_path / "csv"))
    assert rows(preview(spark, ORDERS, str(tmp_path / "csv"))) == data[:5]


def test_landing_files_are_named_for_their_table(spark, tmp_path, batch):
    table = spark.createDataFrame([("  ", "n", None)], CUSTOMERS.landing_schema()).coalesce(1)
    names = write_landing(CUSTOMERS, table, str(tmp_path / "l"))
    assert names == ["customers_raw_0.csv"]
    assert rows(scan(spark, CUSTOMERS, str(tmp_path / "l"), batch), *CUSTOMERS.names) == [
        ("  ", "n", None)
    ]
    assert set(RETAIL) == {"customers", "products", "orders", "order_items", "payments"}


def test_only_loaded_files_are_archived(spark, landing, tmp_path, batch):
    lake, archive = Lake(spark, str(tmp_path / "lake")), tmp_path / "archive"
    (landing / "customers_1.csv").write_text(HEADER + "c1,n,2020-01-01\n")
    ingest(lake, str(landing), batch)
    # One file arrives between load and archive, and the run is repeated.
    (landing / "customers_2.csv").write_text(HEADER + "c2,n,2020-01-01\n")
    ingest(lake, str(landing), batch, archive=str(archive))
    ingest(lake, str(landing), batch, archive=str(archive))
    names = lambda folder: sorted(p.name for p in folder.iterdir() if p.suffix == ".csv")
    assert names(archive) == ["1_customers_1.csv"] and names(landing) == ["customers_2.csv"]
    # The next day brings a file of an old name.
    (landing / "customers_1.csv").write_text(HEADER + "c3,n,2020-01-01\nc4,n,2020-01-01\n")
    second = day_batch(2, "2024-01-02")
    ingest(lake, str(landing), second, archive=str(archive))
    assert names(landing) == []
    assert names(archive) == ["1_customers_1.csv", "2_customers_1.csv", "2_customers_2.csv"]
    assert rows(lake.bronze(CUSTOMERS), "customer_id") == [("c1",), ("c2",), ("c3",), ("c4",)]


def test_a_file_left_in_place_is_landed_once(spark, landing, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    (landing / "customers_[1]*.csv").write_text(HEADER + "c1,n,2020-01-01\n")
    for run_id in (1, 2):
        ingest(lake, str(landing), day_batch(run_id, f"2024-01-0{run_id}"))
    assert rows(lake.bronze(CUSTOMERS), "customer_id", "ingestion_id") == [("c1", 1)]


def test_the_longest_table_name_claims_a_file(spark, landing, tmp_path, batch):
    eu = dataclasses.replace(ORDERS, name="orders_eu")
    specs = {"orders": ORDERS, "orders_eu": eu}
    for name in ("orders_1", "orders_eu_1"):
        (landing / f"{name}.csv").write_text(f"order_id,customer_id,order_date,status\n{name},c,d,s\n")
    lake = Lake(spark, str(tmp_path / "lake"))
    ingest(lake, str(landing), batch, specs)
    assert rows(lake.bronze_daily(ORDERS, 1), "order_id") == [("orders_1",)]
    assert rows(lake.bronze_daily(eu, 1), "order_id") == [("orders_eu_1",)]
    assert rows(scan(spark, ORDERS, str(landing), batch, specs=specs), "order_id") == [("orders_1",)]


def test_every_micro_batch_needs_a_run_of_its_own(spark, landing, tmp_path):
    for n in (1, 2):
        (landing / f"customers_{n}.csv").write_text(HEADER + f"c{n},n,2020-01-01\n")
    lake = Lake(spark, str(tmp_path / "lake"))
    one = day_batch(1, "2024-01-01")
    query = start(lake, CUSTOMERS, str(landing), lambda epoch: one, str(tmp_path / "seen"), max_files=1)
    with pytest.raises(Exception, match="run of its own"):
        query.awaitTermination()
    each = {0: one, 1: day_batch(2, "2024-01-02")}
    query = start(lake, CUSTOMERS, str(landing), each.get, str(tmp_path / "seen"), max_files=1)
    query.awaitTermination()
    assert rows(lake.main(CUSTOMERS), "customer_id") == [("c1",), ("c2",)]
    assert rows(lake.file_log(), "source_file_name", "ingestion_for", "row_count") == [
        ("customers_1.csv", DAILY, 1),
        ("customers_1.csv", HISTORY, 1),
        ("customers_2.csv", DAILY, 1),
        ("customers_2.csv", HISTORY, 1),
    ]


def test_keys_that_agree_in_front_stay_apart(spark, batch):
    long = "k" * 255
    frame = bronze(spark, CUSTOMERS, [(long + "A", "x", "2020-01-01"), (long + "b", "y", "2020-01-01"), (long, "z", "2020-01-01")])
    tagged = checked(CUSTOMERS, frame, batch)
    assert rows(tagged, "customer_id", "reject_reason") == [
        (long, None), (long + "a", "key_too_long"), (long + "b", "key_too_long"),
    ]
    assert tuple(reconciliation(CUSTOMERS, frame, tagged).first()) == ("customers", 3, 0, 0, 2, 1)


def test_history_refuses_an_older_batch(spark, tmp_path):
    for route in ("whole", "changes"):
        newer, older = day_batch(1, "2024-01-05"), day_batch(2, "2024-01-02")
        clean_ = lambda name, b: clean(checked(CUSTOMERS, bronze(spark, CUSTOMERS, [("c1", name, "2020-01-01"), ("c2", "same", "2020-01-01")]), b))  # noqa: E731, B023
        main = merge.first_rows(CUSTOMERS, clean_("new", newer), newer)
        again = clean_("newest", newer)
        late = clean_("old", older)
        if route == "whole":
            do = lambda d, b: merge.upsert_history(CUSTOMERS, main, d, b)  # noqa: E731, B023
        else:
            do = lambda d, b: merge.apply_changes(CUSTOMERS, main, merge.changes(CUSTOMERS, merge.matches(CUSTOMERS, main, d), d, b))  # noqa: E731, B023
        assert rows(do(again, newer), "customer_id", "name") == [("c1", "newest"), ("c2", "same")]
        with pytest.raises(Exception, match="would change the newer version"):
            do(late, older).collect()
        # A batch that changes nothing is no harm, however old it is.
        assert do(clean_("new", older), older).count() == 2
