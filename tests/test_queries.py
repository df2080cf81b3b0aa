import duckdb
import pytest

import __spark_entry__ as contract
from compare import connect, mismatch
from support import SMALL
from tidemark.plans import oracles
from tidemark.plans import queries as registered

# Whole runs through files take long; tests/compare.py covers every query.
SLOW = {"run_log", "stored_order_items", "stored_quarantine", "streamed_payments", "main_key_check"}
SOME = [
    "customers_landed",
    "customers_clean",
    "customers_rejected",
    "customers_history",
    "customers_merge_counts",
    "orders_key_violations",
    "order_items_merged",
    "order_items_with_date",
    "payments_reject_summary",
    "generated_payments",
    "bronze_summary",
    "csv_preview",
    "streamed_customers",
]


def test_every_query_has_sql_and_no_name_is_reserved():
    assert set(registered.build()) == set(oracles.build())
    assert not any("pipeline" in n or n.startswith("op") for n in registered.build())
    assert set(SOME) < set(contract.queries()) and SLOW < set(contract.queries())


def test_all_sql_runs():
    con = connect(SMALL)
    assert isinstance(con, duckdb.DuckDBPyConnection)
    for name, sql in oracles.build().items():
        found = con.execute(sql).fetchall()
        # These tables hold no key twice.
        assert found or name in ("products_key_violations", "orders_key_violations",
                                 "payments_key_violations"), name


@pytest.mark.parametrize("name", SOME)
def test_query_agrees_with_sql(spark, name):
    assert mismatch(spark, connect(SMALL), SMALL, name) is None


def test_entry(spark):
    assert contract.entry(spark).columns == ["reject_reason", "row_count"]
    assert contract.entry(spark).count() == 4


def test_the_session_time_zone_changes_nothing(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("customers_history", "customers_rejected", "customers_landed"):
            assert mismatch(spark, connect(SMALL), SMALL, name) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
