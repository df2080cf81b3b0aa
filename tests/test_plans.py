"""The shape of physical plans, and behaviour when one key holds a large share of the rows."""

import pytest
from pyspark.sql import functions as F

from support import SMALL, day_batch, rows
from tidemark.operators import lookup, merge
from tidemark.operators.dedup import duplicate_count, latest_per_key
from tidemark.operators.quality import checked, clean
from tidemark.retail import CUSTOMERS, ORDERS, PRODUCTS, RETAIL
from tidemark.sources.derived_feed import FIRST, SECOND, frame


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def stored(spark, tmp_path, df, name="t"):
    df.write.parquet(str(tmp_path / name))
    return spark.read.parquet(str(tmp_path / name))


@pytest.mark.parametrize("table", RETAIL)
def test_cleaning_shuffles_once_by_key_and_drops_older_rows_before(spark, tmp_path, table):
    spec = RETAIL[table]
    landed = stored(spark, tmp_path, frame(spark, SMALL, table))
    text = plan(checked(spec, landed, FIRST))
    assert text.count("Exchange ") == 1 and "Exchange hashpartitioning" in text
    assert "row_number(), 1, Partial" in text
    assert "Python" not in text and "UDF" not in text


def test_duplicates_are_counted_before_the_shuffle(spark, tmp_path):
    landed = stored(spark, tmp_path, frame(spark, SMALL, "customers"))
    text = plan(duplicate_count(CUSTOMERS, landed))
    assert text.index("Exchange hashpartitioning") < text.index("partial_count")
    assert "created_at_bronze" not in text  # only compared columns are read


def test_a_small_batch_leaves_the_main_table_unshuffled(spark, tmp_path):
    day = day_batch(2, "2024-01-02")
    main = merge.first_rows(ORDERS, clean(checked(ORDERS, frame(spark, SMALL, "orders"), FIRST)), day)
    main = stored(spark, tmp_path, main, "main")
    daily = clean(checked(ORDERS, frame(spark, SMALL, "orders", SECOND), SECOND))
    daily = stored(spark, tmp_path, daily, "daily")
    text = plan(merge.matches(ORDERS, main, daily))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text
    assert "created_at_silver" not in text  # audit columns of the main table are not read
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        large = plan(merge.matches(ORDERS, main, daily))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin" in large and large.count("hashpartitioning") == 2


def test_a_whole_table_merge_shuffles_each_side_once(spark, tmp_path):
    main = stored(spark, tmp_path, merge.first_rows(
        PRODUCTS, clean(checked(PRODUCTS, frame(spark, SMALL, "products"), FIRST)), FIRST), "main")
    daily = stored(spark, tmp_path, clean(
        checked(PRODUCTS, frame(spark, SMALL, "products", SECOND), SECOND)), "daily")
    assert plan(merge.upsert(PRODUCTS, main, daily, SECOND)).count("hashpartitioning") == 2


def test_a_key_with_most_rows_sends_one_row_per_task(spark, tmp_path):
    n = 20_000
    hot = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    landed = spark.range(0, n, 1, 4).select(
        hot.alias("product_id"),
        F.col("id").cast("string").alias("name"),
        F.lit("c").alias("category"),
        F.lit("1").alias("price"),
        F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("created_at_bronze"),
        F.lit("f").alias("source_file_id"),
    )
    latest = latest_per_key(PRODUCTS, landed)
    kept = latest.filter("product_id = 'hot'").collect()
    assert [r.name for r in kept] == [str(max(i for i in range(n) if i % 3 == 0))]
    assert latest.count() == n - len(range(0, n, 3)) + 1
    exchanged = _shuffled_rows(latest)
    distinct = n - len(range(0, n, 3))
    assert exchanged <= distinct + 4  # one row of the hot key for each of four tasks


def _nodes(node):
    """A finished plan's nodes, looking into adaptive stages."""
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        yield from _nodes(node.executedPlan())
    elif name.endswith("QueryStageExec"):
        yield from _nodes(node.plan())
    else:
        yield name, node
        children = node.children()
        for i in range(children.size()):
            yield from _nodes(children.apply(i))


def _shuffled_rows(df) -> int:
    df.collect()
    for name, node in _nodes(df._jdf.queryExecution().executedPlan()):
        if name == "ShuffleExchangeExec":
            return node.metrics().get("shuffleRecordsWritten").get().value()
    raise AssertionError("no shuffle")


def _shuffled_bytes(df) -> int:
    df.collect()
    nodes = list(_nodes(df._jdf.queryExecution().executedPlan()))
    return sum(n.metrics().get("shuffleBytesWritten").get().value() for name, n in nodes if name == "ShuffleExchangeExec")


def test_copies_are_counted_by_narrow_fingerprints(spark):
    """Rows that are alone send no column; a row with a third of all sends one per task, and none is lost."""
    n = 30_000
    hot = F.col("id") % 3 == 0
    text = lambda name: F.when(hot, F.lit(None).cast("string")).otherwise(F.sha2(F.concat(F.lit(name), F.col("id") % 27_000), 256))
    landed = spark.range(0, n, 1, 4).select(
        F.when(hot, "hot").otherwise((F.col("id") % 27_000).cast("string")).alias("product_id"),
        *[text(c).alias(c) for c in ("name", "category", "price")],
        F.lit(None).cast("timestamp_ntz").alias("created_at_bronze"),
        F.lit("f").alias("source_file_id"),
    )
    counted = duplicate_count(PRODUCTS, landed)
    whole = landed.groupBy(*PRODUCTS.names).agg(F.count(F.lit(1)).alias("c")).agg(F.sum(F.col("c") - 1).cast("bigint"))
    assert counted.first()[0] == whole.first()[0] == 10_000 - 1 + 2_000
    assert _shuffled_bytes(counted) * 2 < _shuffled_bytes(whole)
    # NULL in one column and in another are different rows.
    odd = spark.createDataFrame([("p", None, "a", "1"), ("p", "a", None, "1"), ("p", "a", None, "1")], "product_id string, name string, category string, price string")
    assert duplicate_count(PRODUCTS, odd).first()[0] == 1


def _largest_task_share(df) -> float:
    # The maximum keeps the joined column, and with it the join, in the plan.
    tasks = df.withColumn("task", F.spark_partition_id()).groupBy("task")
    sizes = [r["n"] for r in tasks.agg(F.count(F.lit(1)).alias("n"), F.max("order_date")).collect()]
    return max(sizes) / sum(sizes)


@pytest.mark.parametrize("hot_id", ["o0", "no such order", None])
def test_a_hot_key_of_a_lookup_is_spread_over_tasks(spark, hot_id):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        items = spark.range(0, 30_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit(hot_id)).otherwise(F.concat(F.lit("o"), "id")).alias("order_id"),
            F.col("id").alias("line"),
        )
        orders = spark.range(0, 30_000, 1, 4).filter("id % 5 <> 1").select(
            F.concat(F.lit("o"), "id").alias("order_id"),
            F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 100).cast("int")).alias("order_date"),
        )
        assert [r[0] for r in lookup.hot_keys(items, "order_id").collect()] == [hot_id] * (hot_id is not None)
        dated = lookup.with_order_date(items, orders)
        plain = items.join(lookup.order_dates(orders), "order_id", "left")
        assert dated.exceptAll(plain.select(*dated.columns)).count() == 0
        assert dated.count() == plain.count() == 30_000
        assert _largest_task_share(plain) > 0.3
        assert _largest_task_share(dated) < 0.1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_lookup_key_that_looks_like_a_place_is_still_right(spark):
    items = spark.createDataFrame([("o1",)] * 9 + [(None,), ("o2",)], "order_id string")
    odd = [(f"o1#{i}", "2001-01-01") for i in range(lookup.PLACES)]
    odd += [(str(i), "2001-01-01") for i in range(lookup.PLACES)]
    table = spark.createDataFrame([("o1", "2020-01-01"), *odd], "order_id string, day string")
    found = lookup.lookup(items, table, "order_id", ["day"])
    assert rows(found.distinct()) == [("o1", "2020-01-01"), ("o2", None), (None, None)]


def test_results_do_not_depend_on_how_rows_are_spread(spark):
    landed = frame(spark, SMALL, "customers")
    once = rows(checked(CUSTOMERS, landed, FIRST))
    assert rows(checked(CUSTOMERS, landed.repartition(7), FIRST)) == once
    assert rows(checked(CUSTOMERS, landed.orderBy(F.desc("name")).coalesce(1), FIRST)) == once
