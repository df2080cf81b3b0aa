"""Synthetic retail landing data of any size, as Spark columns over row numbers.

Each function takes a frame with a ``bigint`` column ``i`` (``spark.range`` renamed, or the keys of a
table) and gives one landing-shaped table. The same row number always gives the same row, so tables
made in separate jobs agree and a lost task can be repeated.
"""

from __future__ import annotations

from pyspark.sql import Column as Col
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.picks import one_of, pick
from tidemark.operators.lookup import payments_due

Catalog = tuple[tuple[str, str, str], ...]

# Name, category and price of each product; any list of such triples can be given instead.
CATALOG: Catalog = (
    ("Desk lamp", "Lighting", "24.90"),
    ("Floor lamp", "Lighting", "79.00"),
    ("Bookshelf", "Furniture", "120.00"),
    ("Stool", "Furniture", "35.50"),
    ("Wool rug", "Textiles", "64.25"),
    ("Cushion", "Textiles", "12.75"),
    ("Wall clock", "Decor", "18.40"),
    ("Vase", "Decor", "9.99"),
    ("Tool box", "Hardware", "42.00"),
)
# The value ranges of the retail feed.
STATUSES = ("Completed", "completed", "Pending", "Cancelled")
METHODS = ("card", "Card", "cash", "CASH")
SIGNUP_DAYS = (16000, 19000)
ORDER_DAYS = (18000, 20000)
ITEMS_PER_ORDER = 3
MAX_QUANTITY = 5
PERCENT_WITHOUT_PRICE = 5
PERCENT_WITHOUT_TOTAL = 3

FIRST_NAMES = ("Ada", "Ben", "Chen", "Dina", "Emil", "Fay", "Goro", "Hana", "Ivo", "June")
LAST_NAMES = ("Abbot", "Brook", "Castle", "Dale", "Ember", "Field", "Grove", "Hill", "Isle")


def rows(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n).withColumnRenamed("id", "i")


def _catalog(product: Col, field: int, catalog: Catalog) -> Col:
    return one_of(product, "product", tuple(entry[field] for entry in catalog))


def _price(product: Col, catalog: Catalog) -> Col:
    return _catalog(product, 2, catalog).cast("decimal(10,2)")


def _day(row: Col, purpose: str, bounds: tuple[int, int]) -> Col:
    first, end = bounds
    offset = pick(row, purpose, end - first) + first
    return F.date_add(F.lit("1970-01-01").cast("date"), offset.cast("int"))


def products(ids: DataFrame, catalog: Catalog = CATALOG) -> DataFrame:
    i = F.col("i")
    return ids.select(
        F.concat(F.lit("P"), i).alias("product_id"),
        _catalog(i, 0, catalog).alias("name"),
        _catalog(i, 1, catalog).alias("category"),
        _price(i, catalog).alias("price"),
    )


def customers(ids: DataFrame) -> DataFrame:
    i = F.col("i")
    name = F.concat_ws(" ", one_of(i, "first", FIRST_NAMES), one_of(i, "last", LAST_NAMES))
    return ids.select(
        F.concat(F.lit("C"), i).alias("customer_id"),
        name.alias("name"),
        _day(i, "signup", SIGNUP_DAYS).alias("signup_date"),
    )


def orders(ids: DataFrame, n_customers: int) -> DataFrame:
    i = F.col("i")
    return ids.select(
        F.concat(F.lit("O"), i).alias("order_id"),
        F.concat(F.lit("C"), pick(i, "customer", n_customers)).alias("customer_id"),
        _day(i, "ordered", ORDER_DAYS).alias("order_date"),
        one_of(i, "status", STATUSES).alias("status"),
    )


def order_items(ids: DataFrame, n_products: int, catalog: Catalog = CATALOG) -> DataFrame:
    """One to three rows per order. The price follows from the product number, so nothing is joined."""
    i = F.col("i")
    lines = F.sequence(F.lit(1), pick(i, "lines", ITEMS_PER_ORDER).cast("int") + 1)
    item = F.concat_ws("-", "i", "line")
    product = pick(item, "bought", n_products)
    unpriced = pick(item, "unpriced", 100) < PERCENT_WITHOUT_PRICE
    return (
        ids.select("i", F.explode(lines).alias("line"))
        .select(
            F.concat(F.lit("O"), i).alias("order_id"),
            F.concat(F.lit("P"), product).alias("product_id"),
            (pick(item, "quantity", MAX_QUANTITY) + 1).alias("quantity"),
            F.when(~unpriced, _price(product, catalog)).alias("unit_price"),
        )
        .withColumn("total", (F.col("quantity") * F.col("unit_price")).cast("decimal(10,2)"))
    )


def payments(items: DataFrame, order_rows: DataFrame) -> DataFrame:
    """One payment per order with items, in landing column order."""
    number = F.substring("order_id", 2, 20)
    unpaid = pick(number, "unpaid", 100) < PERCENT_WITHOUT_TOTAL
    return payments_due(items, order_rows).select(
        F.concat(F.lit("PAY"), number).alias("payment_id"),
        one_of(number, "method", METHODS).alias("method"),
        "order_id",
        "order_date",
        F.when(~unpaid, F.col("total")).alias("total"),
        "payment_date",
    )


def feed(
    spark: SparkSession, n_customers: int, n_products: int, n_orders: int, catalog: Catalog = CATALOG
) -> dict[str, DataFrame]:
    """All five landing tables."""
    order_ids = rows(spark, n_orders)
    items = order_items(order_ids, n_products, catalog)
    placed = orders(order_ids, n_customers)
    return {
        "products": products(rows(spark, n_products), catalog),
        "customers": customers(rows(spark, n_customers)),
        "orders": placed,
        "order_items": items,
        "payments": payments(items, placed),
    }
