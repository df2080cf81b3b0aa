import datetime as dt

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from support import bronze, day_batch, rows
from tidemark.operators import merge
from tidemark.operators.quality import checked, clean
from tidemark.retail import CUSTOMERS, ORDERS, PRODUCTS

DAY1, DAY2, DAY3 = (day_batch(i, f"2024-01-0{i}") for i in (1, 2, 3))


def batch_of(spark, spec, data, batch):
    return clean(checked(spec, bronze(spark, spec, data, str(batch.loaded_at)), batch))


def products(spark, prices, batch):
    """A clean product batch from id -> price; other columns never differ."""
    data = [(k, "n", "c", v) for k, v in prices.items()] or [("", "n", "c", "1")]
    return batch_of(spark, PRODUCTS, data, batch)


def customers(spark, names, batch):
    data = [(k, v, "2020-01-01") for k, v in names.items()] or [("", "n", "2020-01-01")]
    return batch_of(spark, CUSTOMERS, data, batch)


def stepwise(spec, main, daily, batch):
    """The change-set route."""
    found = merge.matches(spec, main, daily)
    return merge.apply_changes(spec, main, merge.changes(spec, found, daily, batch))


ROUTES = pytest.mark.parametrize("route", [merge.merge, stepwise])


@ROUTES
def test_changed_rows_are_overwritten_new_ones_added_others_kept(spark, route):
    main = merge.first_rows(PRODUCTS, products(spark, {"p1": "1", "p2": "2", "p3": "3"}, DAY1), DAY1)
    after = route(PRODUCTS, main, products(spark, {"p2": "2", "p3": "4", "p4": "5"}, DAY2), DAY2)
    assert rows(after.selectExpr("product_id", "cast(price as int)", "day(created_at_silver)",
                                 "day(created_at_bronze)")) == [
        ("p1", 1, 1, 1),
        ("p2", 2, 1, 1),
        ("p3", 4, 2, 2),
        ("p4", 5, 2, 2),
    ]


def test_counts_and_sets(spark):
    main = merge.first_rows(PRODUCTS, products(spark, {"p1": "1", "p2": "2", "p3": "3"}, DAY1), DAY1)
    daily = products(spark, {"p2": "2", "p3": "4", "p4": "5"}, DAY2)
    actions = merge.upsert_actions(PRODUCTS, main, daily, DAY2)
    assert tuple(merge.action_counts(actions).first()) == (1, 1, 2)
    assert rows(merge.update_set(PRODUCTS, main, daily, DAY2), "product_id") == [("p3",)]
    assert rows(merge.insert_set(PRODUCTS, main, daily, DAY2), "product_id") == [("p4",)]


@ROUTES
@pytest.mark.parametrize("spec, make", [(PRODUCTS, products), (CUSTOMERS, customers)])
def test_the_same_batch_twice_changes_nothing(spark, route, spec, make):
    main = merge.first_rows(spec, make(spark, {"a": "1", "b": "2"}, DAY1), DAY1)
    daily = make(spark, {"b": "3", "c": "4"}, DAY2)
    once = route(spec, main, daily, DAY2)
    again = route(spec, once, daily, DAY2)
    assert rows(again) == rows(once)
    found = merge.matches(spec, once, daily)
    assert merge.changes(spec, found, daily, DAY2).count() == 0


@ROUTES
def test_null_on_both_sides_is_no_change(spark, route):
    schema = ORDERS.main_schema()
    moment = dt.datetime(2024, 1, 1)
    main = spark.createDataFrame([("o1", "c1", None, None, moment, moment)], schema)
    assert rows(route(ORDERS, main, main, DAY2)) == rows(main)
    filled = spark.createDataFrame([("o1", "c1", None, "done", moment, moment)], schema)
    assert rows(route(ORDERS, main, filled, DAY2), "status") == [("done",)]
    assert rows(route(ORDERS, filled, main, DAY2), "status") == [(None,)]


@ROUTES
def test_a_changed_customer_gets_a_new_version(spark, route):
    main = merge.first_rows(CUSTOMERS, customers(spark, {"c1": "a", "c2": "b"}, DAY1), DAY1)
    after = route(CUSTOMERS, main, customers(spark, {"c1": "a2", "c3": "c"}, DAY3), DAY3)
    shown = after.selectExpr(
        "customer_id", "name", "cast(valid_from as date)", "cast(valid_to as date)", "is_valid"
    )
    day = dt.date
    assert rows(shown) == [
        ("c1", "a", day(2024, 1, 1), day(2024, 1, 2), False),
        ("c1", "a2", day(2024, 1, 3), day(2050, 1, 1), True),
        ("c2", "b", day(2024, 1, 1), day(2050, 1, 1), True),
        ("c3", "c", day(2024, 1, 3), day(2050, 1, 1), True),
    ]
    assert rows(merge.current(after), "customer_id") == [("c1",), ("c2",), ("c3",)]


@ROUTES
def test_a_second_change_on_one_day_replaces_the_version(spark, route):
    main = merge.first_rows(CUSTOMERS, customers(spark, {"c1": "a"}, DAY1), DAY1)
    main = route(CUSTOMERS, main, customers(spark, {"c1": "b"}, DAY2), DAY2)
    main = route(CUSTOMERS, main, customers(spark, {"c1": "c"}, DAY2), DAY2)
    assert rows(main, "name", "is_valid") == [("a", False), ("c", True)]


@ROUTES
def test_a_customer_seen_again_after_closing_is_opened(spark, route):
    main = merge.first_rows(CUSTOMERS, customers(spark, {"c1": "a"}, DAY1), DAY1)
    gone = main.selectExpr(
        *[c for c in main.columns if c != "is_valid"], "false as is_valid"
    )
    after = route(CUSTOMERS, gone, customers(spark, {"c1": "a"}, DAY2), DAY2)
    assert rows(after, "name", "is_valid") == [("a", False), ("a", True)]


def test_close_and_open_sets(spark):
    main = merge.first_rows(CUSTOMERS, customers(spark, {"c1": "a", "c2": "b"}, DAY1), DAY1)
    daily = customers(spark, {"c1": "x", "c2": "b", "c3": "c"}, DAY2)
    assert rows(merge.close_set(CUSTOMERS, main, daily, DAY2), "customer_id", "name") == [("c1", "a")]
    assert rows(merge.open_set(CUSTOMERS, main, daily, DAY2), "customer_id") == [("c1",), ("c3",)]
    actions = merge.history_actions(CUSTOMERS, main, daily, DAY2)
    assert tuple(merge.action_counts(actions).first()) == (1, 2, 1)


VERSIONS = st.dictionaries(st.sampled_from("abcde"), st.sampled_from("123"), max_size=5)


@settings(
    max_examples=3,
    deadline=None,
    derandomize=True,
    phases=[Phase.generate],
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(batches=st.lists(VERSIONS, min_size=2, max_size=3))
def test_both_routes_agree_and_keep_one_current_row(spark, batches):
    days = [DAY1, DAY2, DAY3]
    for spec, make in ((PRODUCTS, products), (CUSTOMERS, customers)):
        whole = step = merge.first_rows(spec, make(spark, batches[0], DAY1), DAY1)
        latest = dict(batches[0])
        for names, batch in zip(batches[1:], days[1:]):
            daily = make(spark, names, batch)
            whole = merge.merge(spec, whole, daily, batch)
            step = stepwise(spec, step, daily, batch)
            latest |= names
        assert rows(whole) == rows(step)
        now = merge.current(whole) if spec.history else whole
        value = "name" if spec.history else "cast(cast(price as int) as string)"
        assert rows(now.selectExpr(spec.key[0], value)) == sorted(latest.items())
