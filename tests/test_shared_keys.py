"""Batches in which few keys repeat, large batches, and constant folders: the short ways give what the long ones give."""

from support import bronze, day_batch, rows

from tidemark.operators import merge
from tidemark.operators.dedup import duplicate_count, latest_per_key, shared_prints
from tidemark.operators.quality import checked, clean
from tidemark.retail import ORDERS, PRODUCTS

DAY1, DAY2 = day_batch(1, "2024-01-01"), day_batch(2, "2024-01-02")

DIRTY = [
    ("P1", "a", "c", "1"),
    (" p1 ", "b", "c", "1"),
    ("P1", "a", "c", "1"),
    ("P2", "only", "c", "2"),
    (None, "x", "c", "3"),
    (None, "y", "c", "3"),
    ("  ", "blank", "c", "4"),
    ("", "empty", None, "4"),
    ("P3", None, None, None),
    ("P3", None, None, None),
]


def test_rows_whose_key_is_their_own_need_no_window(spark):
    landed = bronze(spark, PRODUCTS, DIRTY).repartition(3)
    shared = shared_prints(PRODUCTS, landed).localCheckpoint()
    assert shared.count() == 3
    assert rows(latest_per_key(PRODUCTS, landed, shared)) == rows(latest_per_key(PRODUCTS, landed))
    # Prints that too many keys share change nothing.
    every = spark.createDataFrame([(n,) for n in range(3)], "_key long").unionByName(shared)
    assert rows(checked(PRODUCTS, landed, DAY1, every)) == rows(checked(PRODUCTS, landed, DAY1))
    assert duplicate_count(PRODUCTS, landed, shared).first()[0] == duplicate_count(PRODUCTS, landed).first()[0] == 2
    nothing = landed.filter("false")
    assert shared_prints(PRODUCTS, nothing).isEmpty()
    assert latest_per_key(PRODUCTS, nothing, shared).isEmpty()


def test_one_join_finds_changed_and_fresh_rows(spark):
    first = [("O1", "C1", "2020-01-01", "Pending"), ("O2", "C1", "2020-02-01", "Pending"), ("O3", "C2", "2020-03-01", "Pending")]
    second = [("O1", "C1", "2020-01-01", "Done"), ("O2", "C1", "2020-02-01", "Pending"), ("O2", "C9", "2020-02-01", "Pending"), ("O4", "C2", "2020-03-01", "x")]
    daily = [clean(checked(ORDERS, bronze(spark, ORDERS, data), day)) for data, day in ((first, DAY1), (second, DAY2))]
    main = merge.first_rows(ORDERS, daily[0], DAY1)
    two = merge.changes(ORDERS, merge.matches(ORDERS, main, daily[1]), daily[1], DAY2)
    found = merge.matches(ORDERS, main, daily[1], fresh=True)
    one = merge.changes(ORDERS, found, daily[1], DAY2)
    assert found.count() == 4 and found.filter("changed").count() == 1
    assert rows(one) == rows(two)
    assert [r[0] for r in rows(one.groupBy("action").count())] == ["insert", "update"]
