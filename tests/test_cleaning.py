import datetime as dt
from decimal import Decimal

import pytest

from support import bronze, rows
from tidemark.operators.dedup import duplicate_count, key_conflict_count, latest_per_key
from tidemark.operators.project import project
from tidemark.operators.quality import (
    KeyViolation,
    assert_history,
    assert_unique,
    checked,
    clean,
    key_check,
    key_violations,
    quarantine_rows,
    reconciliation,
    reject_counts,
    reject_summary,
)
from tidemark.retail import CUSTOMERS, ORDER_ITEMS, ORDERS, PAYMENTS, PRODUCTS

GOOD = "2020-01-01"


def reasons(spark, spec, data, batch):
    """Reject reason by first key column."""
    tagged = checked(spec, bronze(spark, spec, data), batch)
    return {r[spec.key[0]]: r["reject_reason"] for r in tagged.collect()}


def test_text_is_trimmed_lowered_and_cut(spark, batch):
    data = [("  Ab" + "x" * 300, "\tTab ", GOOD)]
    (row,) = project(CUSTOMERS, bronze(spark, CUSTOMERS, data), batch).collect()
    assert row.customer_id == "ab" + "x" * 253
    assert row.name == "\ttab"


@pytest.mark.parametrize(
    "text, value",
    [
        ("2024-02-29", dt.date(2024, 2, 29)),
        (" 2024-01-01 ", dt.date(2024, 1, 1)),
        ("2024-02-30", None),
        ("2024-13-01", None),
        ("2024-01-01\n", None),
        ("2024-1-1", None),
        ("22/10/2013", None),
        ("", None),
        (None, None),
    ],
)
def test_dates(spark, batch, text, value):
    (row,) = project(CUSTOMERS, bronze(spark, CUSTOMERS, [("c1", "n", text)]), batch).collect()
    assert row.signup_date == value


@pytest.mark.parametrize(
    "text, value",
    [
        ("1.005", "1.01"),
        ("-1.005", "-1.01"),
        (" 7 ", "7.00"),
        ("1e3", "1000.00"),
        ("99999999.99", "99999999.99"),
        ("100000000", None),
        ("NaN", None),
        ("abc", None),
        ("", None),
    ],
)
def test_decimals(spark, batch, text, value):
    (row,) = project(PRODUCTS, bronze(spark, PRODUCTS, [("p1", "n", "c", text)]), batch).collect()
    assert row.price == (None if value is None else Decimal(value))


def test_spellings_of_one_key_give_one_row_and_the_latest_wins(spark, batch):
    data = [
        ("P1", "old", "c", "1", "2024-01-01 00:00:00"),
        (" p1 ", "new", "c", "2", "2024-01-01 01:00:00"),
    ]
    assert rows(checked(PRODUCTS, bronze(spark, PRODUCTS, data), batch), "product_id", "name") == [
        ("p1", "new")
    ]


def test_unknown_load_time_counts_as_latest(spark, batch):
    data = [("p1", "timed", "c", "1"), ("p1", "untimed", "c", "1", None)]
    assert rows(latest_per_key(PRODUCTS, bronze(spark, PRODUCTS, data)), "name") == [("untimed",)]


def test_ties_are_settled_by_landing_text_whatever_the_row_order(spark, batch):
    data = [("p1", None, "c", "1"), ("p1", "b", "c", "9"), ("p1", "b", "c", "10")]
    for order in (data, data[::-1]):
        found = latest_per_key(PRODUCTS, bronze(spark, PRODUCTS, order).repartition(3))
        assert rows(found, "name", "price") == [("b", "9")]


def test_null_empty_and_blank_keys_stay_apart(spark, batch):
    data = [(None, "a", GOOD), (None, "b", GOOD), ("", "c", GOOD), ("  ", "d", GOOD), ("  ", "e", GOOD)]
    tagged = checked(CUSTOMERS, bronze(spark, CUSTOMERS, data), batch)
    assert rows(reject_counts(tagged)) == [("missing_pk", 3)]


def test_a_key_that_does_not_fit_is_rejected_whole(spark, batch):
    edge = "x" * 254 + " " + "tail"
    short = "x" * 254
    tagged = checked(CUSTOMERS, bronze(spark, CUSTOMERS, [(edge, "a", GOOD), (short, "b", GOOD)]), batch)
    assert rows(tagged, "customer_id", "reject_reason") == [(edge, "key_too_long"), (short, None)]


def test_an_older_good_row_is_lost_when_the_latest_is_bad(spark, batch):
    data = [("c1", "n", GOOD, "2024-01-01 00:00:00"), ("c1", None, GOOD, "2024-01-01 01:00:00")]
    assert reasons(spark, CUSTOMERS, data, batch) == {"c1": "missing_required_fields"}


def test_date_bounds(spark, batch):
    data = [
        ("in1", "n", "2024-01-02"),
        ("out1", "n", "2024-01-03"),
        ("in2", "n", "2015-01-01"),
        ("out2", "n", "2014-12-31"),
    ]
    assert reasons(spark, CUSTOMERS, data, batch) == {
        "in1": None,
        "out1": "future_or_past_date",
        "in2": None,
        "out2": "future_or_past_date",
    }


def test_first_rule_wins(spark, batch):
    data = [
        ("a", None, "1999-01-01"),
        ("", None, "1999-01-01"),
    ]
    assert reasons(spark, CUSTOMERS, data, batch) == {
        "a": "missing_required_fields",
        "": "missing_pk",
    }


def test_price_rules(spark, batch):
    prices = {"a": "0", "b": "-0.01", "c": "NaN", "d": "abc", "e": "100000000", "f": "1.005"}
    data = [(k, "n", "c", v) for k, v in prices.items()]
    assert reasons(spark, PRODUCTS, data, batch) == {
        "a": None,
        "b": "negative_price",
        "c": "missing_required_fields",
        "d": "missing_required_fields",
        "e": "missing_required_fields",
        "f": None,
    }


def test_second_key_column_and_other_tables_rules(spark, batch):
    assert reasons(spark, ORDERS, [("o1", " ", GOOD, "s"), ("o2", "c", GOOD, "")], batch) == {
        "o1": "missing_pk",
        "o2": "missing_required_fields",
    }
    items = [("o1", "p", "-1", "1", "1"), ("o2", "p", "1", "-1", "1"), ("o3", "p", "1", "1", "-1")]
    assert set(reasons(spark, ORDER_ITEMS, items, batch).values()) == {"negative_values"}
    payments = [
        ("y1", "m", "o", "2030-01-01", "1", GOOD),
        ("y2", "m", "o", GOOD, "1", "2010-01-01"),
        ("y3", "m", "o", GOOD, "-1", GOOD),
        ("y4", "m", None, GOOD, "1", GOOD),
    ]
    assert reasons(spark, PAYMENTS, payments, batch) == {
        "y1": "future_or_past_date",
        "y2": "future_or_past_date",
        "y3": "negative_total",
        "y4": "missing_pk",
    }


def test_quarantine_keeps_typed_values_and_nulls(spark, batch):
    tagged = checked(PRODUCTS, bronze(spark, PRODUCTS, [(" P1", 'say "hi"', None, "-2")]), batch)
    (row,) = quarantine_rows(PRODUCTS, tagged, batch).collect()
    assert (row.ingestion_id, row.table_name, row.reject_reason) == (
        1,
        "products",
        "missing_required_fields",
    )
    assert row.raw_row == (
        '{"product_id":"p1","name":"say \\"hi\\"","category":null,"price":-2.00,'
        '"created_at_bronze":"2024-01-01T00:00:00.000000",'
        '"created_at_silver":"2024-01-01T00:00:00.000000","source_file_id":"1/f.csv",'
        '"reject_reason":"missing_required_fields"}'
    )


def test_summary_shows_every_rule_even_without_rejects(spark, batch):
    tagged = checked(PRODUCTS, bronze(spark, PRODUCTS, [("p1", "n", "c", "1")]), batch)
    assert reject_summary(PRODUCTS, tagged).first().asDict() == {
        "clean": 1,
        "missing_pk": 0,
        "key_too_long": 0,
        "missing_required_fields": 0,
        "negative_price": 0,
    }


def test_duplicates_are_counted_on_landing_text(spark):
    data = [("p1", "n", "c", "1")] * 3 + [("P1", "n", "c", "1"), ("p1", "n", "c", "2")]
    frame = bronze(spark, PRODUCTS, data + [(None, None, None, None)] * 2)
    assert duplicate_count(PRODUCTS, frame).first()[0] == 3
    assert key_conflict_count(PRODUCTS, frame).first()[0] == 1
    assert duplicate_count(PRODUCTS, frame.filter("false")).first()[0] == 0


def test_rows_in_are_rows_out(spark, batch):
    data = [("p1", "n", "c", "1"), ("p1", "n", "c", "2"), ("p2", "n", "c", "-1"), (None, "n", "c", "1")]
    frame = bronze(spark, PRODUCTS, data)
    found = reconciliation(PRODUCTS, frame, checked(PRODUCTS, frame, batch)).first()
    assert tuple(found) == ("products", 4, 1, 0, 2, 1)


def test_key_checks(spark, batch):
    typed = project(PRODUCTS, bronze(spark, PRODUCTS, [("p1", "a", "c", "1"), ("P1 ", "b", "c", "1")]), batch)
    assert rows(key_violations(typed, PRODUCTS.key)) == [("p1", 2)]
    assert tuple(key_check(typed, PRODUCTS.key).first()) == (2, 1)
    with pytest.raises(KeyViolation):
        assert_unique(typed, PRODUCTS.key, "products")
    good = clean(checked(PRODUCTS, bronze(spark, PRODUCTS, [("p1", "a", "c", "1")]), batch))
    assert assert_unique(good, PRODUCTS.key, "products") == 1


def test_history_check_finds_two_current_rows(spark):
    schema = "customer_id string, valid_from timestamp_ntz, is_valid boolean"
    first, second = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    good = spark.createDataFrame([("c1", first, False), ("c1", second, True)], schema)
    assert_history(CUSTOMERS, good)
    bad = spark.createDataFrame([("c1", first, True), ("c1", second, True)], schema)
    with pytest.raises(KeyViolation):
        assert_history(CUSTOMERS, bad)
