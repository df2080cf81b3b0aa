"""Queries whose work must be dealt over tasks, on tables of the tests' own."""

from dataclasses import replace

import duckdb
import pytest
from pyspark.sql import functions as F

from compare import mismatch
from tidemark.plans import queries as registered
from tidemark.retail import ORDERS
from tidemark.sources.landing import route, routed_to

KEYS = 400


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder of small source tables, each in several files."""
    folder = str(tmp_path_factory.mktemp("tables"))
    i = spark.range(1, KEYS + 1, numPartitions=4)
    frames = {
        "customer": i.selectExpr("id as c_custkey", "concat('Customer#', id) as c_name"),
        "part": i.selectExpr(
            "id as p_partkey", "concat('part ', id) as p_name", "'TIN' as p_type", "900.5D + id as p_retailprice"
        ),
        "orders": i.selectExpr(
            "id as o_orderkey", "id % 90 + 1 as o_custkey", "date_add(date'1996-01-01', int(id)) as o_orderdate",
            "case when id % 3 = 0 then 'O' else 'F' end as o_orderstatus",
        ),
        "lineitem": i.selectExpr("id as l_orderkey", "explode(array(1, 2, 3)) as l_linenumber").selectExpr(
            "l_orderkey", "l_orderkey * 7 % 390 + l_linenumber as l_partkey", "l_linenumber",
            "double(l_linenumber * 2) as l_quantity",
        ),
    }
    for name, frame in frames.items():
        frame.write.parquet(f"{folder}/{name}.parquet")
    return folder


def sql_of(folder):
    con = duckdb.connect()
    for name in ("customer", "part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    return con


def test_archived_tables_are_written_by_several_tasks(spark, tables, monkeypatch):
    written = {}
    plain = registered.write_landing

    def counted(spec, *args):
        written[spec.name] = plain(spec, *args)
        return written[spec.name]

    monkeypatch.setattr(registered, "write_landing", counted)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # a task for each file
    try:
        assert mismatch(spark, sql_of(tables), tables, "archived_files") is None
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    # Those that are not joined keep the tasks of their source.
    assert all(len(written[name]) > 1 for name in ("customers", "products", "orders", "notes"))


def test_files_of_a_table_are_one_row_and_no_file_is_lost_in_it(spark):
    files = spark.createDataFrame(
        [("1_a_raw_0.csv", "archive", 3), ("1_a_raw_1.csv", "archive", 4), ("1_a_raw_10.csv", "archive", 5),
         ("1_b_raw_2.csv", "archive", 1), ("1_b_raw_10.csv", "archive", 1), ("1_c_raw_0.csv", "archive", 1),
         ("1_c_raw_1.csv", "archive", None), ("a_raw_1.csv", "landing", None)],
        "file_name string, place string, row_count bigint",
    )
    found = sorted(map(tuple, registered._by_table(files).collect()))
    assert found == [
        ("1_a_raw_0.csv", "archive", 12), ("1_b_raw_2.csv", "archive", 2), ("1_c_raw_0.csv", "archive", None),
        ("a_raw_1.csv", "landing", None),
    ]


def test_a_file_belongs_to_the_table_with_the_longest_name(spark):
    specs = {name: replace(ORDERS, name=name) for name in ("orders", "orders_old", "orders_old_2", "pay", "a+b")}
    files = spark.createDataFrame(
        [(f"{n}{rest}",) for n in specs for rest in ("_1.csv", ".csv", "_old", "_2.csv", "")], "name string"
    )
    for name in specs:
        starting = files.filter(F.col("name").startswith(name))
        told = starting.select("name", routed_to(F.col("name"), name, specs), route(F.col("name"), specs) == name)
        assert all(ours == routed for _, ours, routed in told.collect())
    plan = files.select(routed_to(F.col("name"), "orders"))._jdf.queryExecution().toString()
    assert "regexp" not in plan.lower()
