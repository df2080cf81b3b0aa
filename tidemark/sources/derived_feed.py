"""Landing-shaped retail frames derived from star-schema Parquet tables, with dirt added by rule.

The rules use whole-number arithmetic on keys only, so any engine derives the same rows. The first
batch holds every key; the second holds every third key, some of them changed, and new keys. Each
source table is scanned once per frame.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column as Col
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import moment
from tidemark.spec import Batch

FIRST = Batch(1, dt.date(2024, 1, 1), dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 6))
SECOND = Batch(2, dt.date(2024, 1, 2), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2, 6))
LATE = dt.datetime(2024, 1, 1, 1)

NEW_KEYS = 1_000_000

# What a derived row stands for.
BASE, COPY, LATE_VERSION, NEW = "base", "copy", "late", "new"


def _source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _every(k: Col, n: int) -> Col:
    return k % n == 0


def _text(col: Col) -> Col:
    return col.cast("decimal(10,2)").cast("string")


def _wanted(rows: DataFrame, k: Col, batch: Batch) -> DataFrame:
    """Source rows that have a role in the batch, for work that comes before the roles."""
    return rows.filter(_every(k, 3) | _every(k, 50)) if batch is SECOND else rows


def _with_roles(rows: DataFrame, k: Col, batch: Batch, extras: bool = False) -> DataFrame:
    """Repeat a row for each role it has in the batch."""
    if batch is SECOND:
        roles = [F.when(_every(k, 3), BASE), F.when(_every(k, 50), NEW)]
    else:
        roles = [F.lit(BASE)]
        if extras:
            roles += [F.when(_every(k, 20), COPY), F.when(_every(k, 33), LATE_VERSION)]
    if len(roles) == 1:
        return rows.withColumn("role", roles[0])
    return rows.withColumn("role", F.explode(F.array_compact(F.array(*roles))))


def _key(k: Col) -> Col:
    return F.when(F.col("role") == NEW, k + NEW_KEYS).otherwise(k)


def _changed(k: Col, batch: Batch) -> Col:
    if batch is not SECOND:
        return F.lit(False)
    return (F.col("role") == BASE) & _every(k, 6)


def _landed(rows: DataFrame, table: str, batch: Batch, *columns: Col) -> DataFrame:
    late = F.col("role") == LATE_VERSION
    file_name = F.concat(
        F.lit(f"{batch.ingestion_id}/{table}_"), F.when(late, "late").otherwise("raw"), F.lit(".csv")
    )
    loaded = F.when(late, moment(LATE)).otherwise(moment(batch.loaded_at))
    return rows.select(
        *columns,
        loaded.alias("created_at_bronze"),
        file_name.alias("source_file_id"),
    )


def customers(spark: SparkSession, sf_dir: str, batch: Batch = FIRST) -> DataFrame:
    k = F.col("c_custkey")
    source = _source(spark, sf_dir, "customer").select("c_custkey", "c_name")
    rows = _with_roles(source, k, batch, extras=True)
    plain = F.concat(F.lit("C"), _key(k))
    customer_id = (
        F.when(F.col("role") == NEW, plain)
        .when(_every(k, 97), F.lit(None))
        .when(_every(k, 89), F.lit("   "))
        .when(_every(k, 7), F.concat(F.lit("  "), plain, F.lit(" ")))
        .otherwise(plain)
    )
    suffix = (
        F.when(F.col("role") == LATE_VERSION, " v2")
        .when(_changed(k, batch), " changed")
        .otherwise("")
    )
    name = F.when(~_every(k, 53), F.concat("c_name", suffix))
    signed = F.date_add(F.lit(dt.date(2013, 10, 22)), (k * 37 % 3000).cast("int"))
    signup = (
        F.when(_every(k, 61), "22/10/2013")
        .when(_every(k, 59), "2024-13-01")
        .when(_every(k, 71), "2031-01-01")
        .otherwise(signed.cast("string"))
    )
    return _landed(
        rows,
        "customers",
        batch,
        customer_id.alias("customer_id"),
        name.alias("name"),
        signup.alias("signup_date"),
    )


def products(spark: SparkSession, sf_dir: str, batch: Batch = FIRST) -> DataFrame:
    k = F.col("p_partkey")
    source = _source(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    rows = _with_roles(source, k, batch)
    listed = F.col("p_retailprice").cast("decimal(10,2)")
    raised = (listed + F.lit("1.00").cast("decimal(10,2)")).cast("decimal(10,2)")
    price = (
        F.when(_every(k, 41), "-1.00")
        .when(_every(k, 43), F.lit(None))
        .when(_every(k, 47), "abc")
        .when(_changed(k, batch), raised.cast("string"))
        .otherwise(listed.cast("string"))
    )
    return _landed(
        rows,
        "products",
        batch,
        F.concat(F.lit("P"), _key(k)).alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        price.alias("price"),
    )


def _order_day(col: Col) -> Col:
    """The source's dates, moved into the accepted range."""
    return F.add_months(col.cast("date"), 240)


def orders(spark: SparkSession, sf_dir: str, batch: Batch = FIRST) -> DataFrame:
    k = F.col("o_orderkey")
    source = _source(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"
    )
    rows = _with_roles(source, k, batch)
    ordered = (
        F.when(_every(k, 83), "2014-12-31")
        .when(_every(k, 79), "2031-01-01")
        .otherwise(_order_day(F.col("o_orderdate")).cast("string"))
    )
    status = (
        F.when(_every(k, 101), F.lit(None))
        .when(_changed(k, batch), "Cancelled")
        .when(F.col("o_orderstatus") == "O", "Completed")
        .when(F.col("o_orderstatus") == "F", "completed")
        .otherwise("Pending")
    )
    return _landed(
        rows,
        "orders",
        batch,
        F.concat(F.lit("O"), _key(k)).alias("order_id"),
        F.concat(F.lit("C"), "o_custkey").alias("customer_id"),
        ordered.alias("order_date"),
        status.alias("status"),
    )


def _priced_lines(spark: SparkSession, sf_dir: str, batch: Batch) -> DataFrame:
    """Lines of a batch with the price of their part; one line in twenty has none."""
    lines = _source(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_partkey").alias("p_partkey"), "l_linenumber", "l_quantity"
    )
    parts = _source(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_retailprice").cast("decimal(10,2)").alias("price")
    )
    lines = _wanted(lines, F.col("l_orderkey"), batch)
    m = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    return lines.join(parts, "p_partkey", "left").select(
        "l_orderkey",
        "p_partkey",
        F.col("l_quantity").cast("decimal(10,2)").alias("quantity"),
        F.when(~_every(m, 20), F.col("price")).alias("unit_price"),
        _every(m, 37).alias("bad_quantity"),
    )


def order_items(spark: SparkSession, sf_dir: str, batch: Batch = FIRST) -> DataFrame:
    k = F.col("l_orderkey")
    rows = _with_roles(_priced_lines(spark, sf_dir, batch), k, batch)
    one_more = (F.col("quantity") + F.lit("1.00").cast("decimal(10,2)")).cast("decimal(10,2)")
    quantity = F.when(_changed(k, batch), one_more).otherwise(F.col("quantity"))
    total = (quantity * F.col("unit_price")).cast("decimal(10,2)")
    return _landed(
        rows,
        "order_items",
        batch,
        F.concat(F.lit("O"), _key(k)).alias("order_id"),
        F.concat(F.lit("P"), "p_partkey").alias("product_id"),
        F.when(F.col("bad_quantity"), "-1").otherwise(quantity.cast("string")).alias("quantity"),
        F.col("unit_price").cast("string").alias("unit_price"),
        total.cast("string").alias("total"),
    )


def payments(spark: SparkSession, sf_dir: str, batch: Batch = FIRST) -> DataFrame:
    k = F.col("o_orderkey")
    line_total = (F.col("quantity") * F.col("unit_price")).cast("decimal(10,2)")
    totals = (
        _priced_lines(spark, sf_dir, batch)
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.coalesce(F.sum(line_total), F.lit(0)).cast("decimal(10,2)").alias("order_total"))
    )
    dates = _source(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    rows = _with_roles(totals.join(_wanted(dates, k, batch), "o_orderkey"), k, batch)
    ordered = _order_day(F.col("o_orderdate"))
    method = F.when(_changed(k, batch), "transfer").otherwise(
        F.element_at(
            F.array(*[F.lit(m) for m in ("card", "Card", "cash", "CASH")]),
            (k % 4).cast("int") + 1,
        )
    )
    total = (
        F.when(_every(k, 33), F.lit(None))
        .when(_every(k, 67), "-5.00")
        .otherwise(F.col("order_total").cast("string"))
    )
    return _landed(
        rows,
        "payments",
        batch,
        F.concat(F.lit("PAY"), _key(k)).alias("payment_id"),
        method.alias("method"),
        F.concat(F.lit("O"), _key(k)).alias("order_id"),
        ordered.cast("string").alias("order_date"),
        total.alias("total"),
        F.date_add(ordered, 1).cast("string").alias("payment_date"),
    )


FRAMES = {
    "customers": customers,
    "products": products,
    "orders": orders,
    "order_items": order_items,
    "payments": payments,
}


def number(spec: TableSpec) -> Col:
    """The number in a row's first key column; 0 without one."""
    digits = F.regexp_extract(F.col(spec.key[0]), "([0-9]+)", 1)
    return F.coalesce(digits.try_cast("bigint"), F.lit(0))


def hard(spec: TableSpec, rows: DataFrame, batch: Batch = FIRST) -> DataFrame:
    """Landing rows made hard: exact copies, a key in two spellings with a third of them, NULL and blank keys.

    All rows are loaded at once, so ties are settled by their contents.
    """
    n = F.col("_number")
    kinds = [F.lit("plain")] + [
        F.when(_every(n, every), kind) for every, kind in ((5, "copy"), (3, "hot"), (17, "null"), (19, "blank"))
    ]
    numbered = rows.select(*spec.names, number(spec).alias("_number"))
    # The rows may take joins to make, so they are made once and repeated where they are.
    repeated = numbered.withColumn("_kind", F.explode(F.array(*kinds))).filter(F.col("_kind").isNotNull())

    def spelt(key: str) -> Col:
        kind = F.col("_kind")
        hot = F.when(n % 2 == 0, " HOT ").otherwise("hot")
        plain = F.when(kind.isin("plain", "copy"), F.col(key))
        return plain.when(kind == "hot", hot).when(kind == "blank", "  ").alias(key)

    return repeated.select(
        *[spelt(c) if c in spec.key else F.col(c) for c in spec.names],
        moment(batch.loaded_at).alias("created_at_bronze"),
        F.lit(f"{batch.ingestion_id}/{spec.name}_hard.csv").alias("source_file_id"),
    )


def broken_lines(spec: TableSpec, rows: DataFrame) -> DataFrame:
    """One column named like a header: lines that have fewer fields than it."""
    n = number(spec)
    return rows.filter(_every(n, 13)).select(F.concat(F.lit("broken "), n).alias(",".join(spec.names)))


def frame(spark: SparkSession, sf_dir: str, table: str, batch: Batch = FIRST) -> DataFrame:
    return FRAMES[table](spark, sf_dir, batch)
