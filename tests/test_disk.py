"""What a run leaves on the disks of its executors, and how often it writes or reads a row on the way."""

import os
import time

import pytest

from support import bronze, day_batch, rows
from tidemark.operators.dedup import duplicate_count
from tidemark.plans import silver
from tidemark.plans.run import refine_all
from tidemark.plans.silver import refine
from tidemark.retail import ORDERS, PAYMENTS, PRODUCTS
from tidemark.session import WHILE_WRITING, while_writing
from tidemark.sources.derived_feed import hard
from tidemark.sources.store import Lake
from tidemark.spec import MALFORMED

DAYS = [day_batch(n, f"2024-01-0{n}") for n in (1, 2)]


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def land(lake, spec, data, day):
    landed = bronze(lake.spark, spec, data)
    lake.write_bronze(spec, landed.selectExpr(*spec.names, f"string(null) as {MALFORMED}", "created_at_bronze", "source_file_id"), day.ingestion_id)


def shuffle_files(spark) -> set[str]:
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in found for _, _, files in os.walk(d.getPath()) for f in files if f.startswith("shuffle_") and f.endswith(".data")}


def test_shuffle_files_go_when_the_step_that_made_them_ends(spark, lake):
    before = shuffle_files(spark)
    for n, day in enumerate(DAYS):
        land(lake, ORDERS, [(f"o{i}", "c", f"2020-0{i % 5 + 1}-0{n + 1}", "s") for i in range(50)] * 2, day)
        refine(lake, ORDERS, day)
    until = time.monotonic() + 20
    while (left := shuffle_files(spark) - before) and time.monotonic() < until:
        time.sleep(0.2)
    assert not left
    assert lake.main(ORDERS).count() == 50


def test_settings_while_writing_are_taken_back_by_the_last_and_a_choice_of_the_session_stays(spark):
    name = next(iter(WHILE_WRITING))
    assert spark.conf.get(name, None) is None
    with while_writing(spark):
        with pytest.raises(ZeroDivisionError), while_writing(spark):
            1 / 0
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name, None) is None
    spark.conf.set(name, "false")
    try:
        with while_writing(spark):
            assert spark.conf.get(name) == "false"
        assert spark.conf.get(name) == "false"
    finally:
        spark.conf.unset(name)


def test_hard_rows_are_made_from_one_pass(spark):
    data = [(f"PAY{n}" if n else None, "card", f"O{n}", "2020-01-01", None if n % 4 else "1.00", "2020-01-02") for n in range(120)]
    found = hard(PAYMENTS, bronze(spark, PAYMENTS, data + data[:3]))
    wanted = []
    for row in data + data[:3]:
        n = int(row[0][3:]) if row[0] else 0
        keys = [(row[0], row[2])] * (1 + (n % 5 == 0))
        keys += [k for every, k in ((3, (" HOT ",) * 2 if n % 2 == 0 else ("hot",) * 2), (17, (None, None)), (19, ("  ", "  "))) if n % every == 0]
        wanted += [(a, row[1], b, *row[3:]) for a, b in keys]
    assert rows(found, *PAYMENTS.names) == sorted(wanted, key=repr)
    assert found.columns == [*PAYMENTS.names, "created_at_bronze", "source_file_id"]
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in text and text.count("Scan ExistingRDD") == 1


def test_copies_under_many_repeated_keys_are_counted_by_one_shuffle_of_distinct_rows(spark, lake, monkeypatch):
    data = [("P1", None, "a", "1")] * 3 + [("P1", "a", None, "1")] * 2 + [(None, None, None, None)] * 2 + [("P2", "b", "c", "2"), (" P2", "b", "c", "2")]
    landed = bronze(spark, PRODUCTS, data)
    counted = duplicate_count(PRODUCTS, landed, many=True)
    assert counted.first()[0] == duplicate_count(PRODUCTS, landed).first()[0] == 4
    assert duplicate_count(PRODUCTS, landed.filter("false"), many=True).first()[0] == 0
    text = counted._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and text.count("hashpartitioning") == 1
    seen = []
    plain = silver.duplicate_count
    monkeypatch.setattr(silver, "duplicate_count", lambda *args: seen.append(args[2:]) or plain(*args))
    monkeypatch.setattr(silver, "FEW_SHARED", 0)
    land(lake, PRODUCTS, data, DAYS[0])
    refine_all(lake, DAYS[0], {"products": PRODUCTS})
    assert seen == [(None, True)]
    assert lake.run_log().select("silver_daily_duplicate_count").first()[0] == 4
