"""Enrichment of large tables from tables that hold each key once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot if it holds more than one row in this many. At most that many keys can be, so their
# values are a table of known small size.
HOT_SHARE = 500
# Items the frequency sketch tracks: enough to find every key above that share.
TRACKED = 10_000
PLACES = 4096


def hot_keys(facts: DataFrame, on: str) -> DataFrame:
    """Keys that hold a large share of the rows: one pass over one column, with a sketch per task.

    The sketch never misses a key above its error bound (about 1/7500 of the rows here). A key it
    reports needlessly costs nothing but a line in a small table.
    """
    top = facts.agg(
        F.expr(f"approx_top_k({on}, {HOT_SHARE}, {TRACKED})").alias("top"),
        F.count(F.lit(1)).alias("n"),
    )
    return (
        top.select("n", F.explode("top").alias("t"))
        .filter(F.col("t.count") * HOT_SHARE > F.col("n"))
        .select(F.col("t.item").alias(on))
        .filter(F.col(on).isNotNull())
    )


def lookup(facts: DataFrame, table: DataFrame, on: str, values: list[str]) -> DataFrame:
    """Left join that adds ``values`` by a text key; a key missing from ``table`` gives NULL.

    ``table`` must hold a key once. Values of hot keys travel as a broadcast of at most ``HOT_SHARE``
    rows. The rows of hot keys, and rows without a key, are spread over all tasks by their content
    instead of meeting in one, so no task gets more than its part whatever the keys look like.
    """
    wanted = table.select(on, *values)
    hot = hot_keys(facts, on)
    found = wanted.join(F.broadcast(hot), on, "left_semi")
    known = hot.join(F.broadcast(found), on, "left").select(
        on, F.lit(True).alias("_hot"), *[F.col(v).alias(f"_hot_{v}") for v in values]
    )
    place = F.pmod(F.xxhash64(*facts.columns), F.lit(PLACES)).cast("string")
    spread = F.col("_hot") | F.col(on).isNull()
    at = F.when(spread, F.concat_ws("#", F.col(on), place)).otherwise(F.col(on))
    held = wanted.select(F.col(on).alias("_at"), *[F.col(v).alias(f"_held_{v}") for v in values])
    # Spread rows take their value from the broadcast, whatever their place happens to match.
    return (
        facts.join(F.broadcast(known), on, "left")
        .withColumn("_at", at)
        .join(held, "_at", "left")
        .select(
            *facts.columns,
            *[
                F.when(spread, F.col(f"_hot_{v}")).otherwise(F.col(f"_held_{v}")).alias(v)
                for v in values
            ],
        )
    )


def with_unit_price(items: DataFrame, products: DataFrame) -> DataFrame:
    """Order items with the price of their product as ``unit_price``."""
    prices = products.select("product_id", F.col("price").alias("unit_price"))
    return lookup(items, prices, "product_id", ["unit_price"])


def order_dates(orders: DataFrame) -> DataFrame:
    """One date per order id: the latest, should several customers share the id."""
    return orders.groupBy("order_id").agg(F.max("order_date").alias("order_date"))


def with_order_date(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Order items with the date of their order; NULL where the order is unknown."""
    return lookup(items, order_dates(orders), "order_id", ["order_date"])


def missing_order_dates(items: DataFrame) -> DataFrame:
    """One row: items in all, and items whose order is unknown."""
    return items.agg(
        F.count(F.lit(1)).alias("items"),
        F.count_if(F.col("order_date").isNull()).alias("without_order"),
    )


def order_totals(items: DataFrame) -> DataFrame:
    """Sum of item totals per order; items without a total are left out, no totals give 0.

    The sum is wider than its parts, so no order is too large for it.
    """
    return items.groupBy("order_id").agg(
        F.coalesce(F.sum("total"), F.lit(0).cast("decimal(10,2)")).alias("total")
    )


def payments_due(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Per order with items: its total, its date and a payment date one day later."""
    # Totals hold an order once, and an order id is rarely shared, so no key of this join is hot.
    dated = orders.select("order_id", "order_date").join(order_totals(items), "order_id")
    return dated.withColumn("payment_date", F.date_add("order_date", 1))
