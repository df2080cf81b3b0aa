from support import rows
from tidemark.operators import generate
from tidemark.operators.lookup import order_totals, payments_due
from tidemark.operators.quality import checked, reject_counts
from tidemark.plans.run import run
from tidemark.retail import RETAIL
from tidemark.sources.export import write_landing
from tidemark.sources.store import Lake


def test_feed_has_the_declared_shape(spark):
    feed = generate.feed(spark, 50, 40, 200)
    assert {t: f.columns for t, f in feed.items()} == {t: list(s.names) for t, s in RETAIL.items()}
    assert feed["customers"].count() == 50 and feed["products"].count() == 40
    assert feed["orders"].count() == feed["payments"].count() == 200
    per_order = feed["order_items"].groupBy("order_id").count()
    assert per_order.count() == 200
    assert {r["count"] for r in per_order.collect()} == {1, 2, 3}
    days = feed["orders"].selectExpr("min(unix_date(order_date))", "max(unix_date(order_date))").first()
    assert 18000 <= days[0] <= days[1] < 20000


def test_prices_follow_products_and_some_values_are_missing(spark):
    feed = generate.feed(spark, 50, 40, 2000)
    items, products = feed["order_items"], feed["products"]
    wrong = items.join(products, "product_id").filter("unit_price is not null and unit_price <> price")
    assert wrong.count() == 0
    assert items.join(products, "product_id", "left_anti").count() == 0
    assert items.filter("unit_price is null and total is not null").count() == 0
    unpriced = items.filter("unit_price is null").count() / items.count()
    assert 0.03 < unpriced < 0.07
    unpaid = feed["payments"].filter("total is null").count() / 2000
    assert 0.015 < unpaid < 0.045


def test_the_same_numbers_give_the_same_rows(spark):
    ids = generate.rows(spark, 100)
    assert rows(generate.orders(ids, 10)) == rows(generate.orders(ids.repartition(5), 10))


def test_totals_skip_missing_values(spark):
    items = spark.createDataFrame(
        [("o1", "1.50"), ("o1", None), ("o1", "2.00"), ("o2", None)], "order_id string, t string"
    ).selectExpr("order_id", "cast(t as decimal(10,2)) as total")
    assert [(k, str(v)) for k, v in rows(order_totals(items))] == [("o1", "3.50"), ("o2", "0.00")]
    orders = spark.createDataFrame([("o1", "2024-02-28")], "order_id string, d string").selectExpr(
        "order_id", "cast(d as date) as order_date"
    )
    due = payments_due(items, orders).first()
    assert (due.order_id, str(due.total), str(due.payment_date)) == ("o1", "3.50", "2024-02-29")


def test_generated_files_go_through_a_whole_run(spark, tmp_path, batch):
    feed = generate.feed(spark, 20, 10, 100)
    for name, spec in RETAIL.items():
        write_landing(spec, feed[name], str(tmp_path / "landing"))
    lake = Lake(spark, str(tmp_path / "lake"))
    done = run(lake, str(tmp_path / "landing"), batch, parallel=True)
    for name, spec in RETAIL.items():
        found = checked(spec, lake.bronze_daily(spec, 1), batch)
        counts = {r[0]: r[1] for r in reject_counts(found).collect()}
        assert done[name].main_rows == counts.get("clean", 0)
        logged = lake.run_log().filter(f"table_name = '{name}'").first()
        assert logged.silver_daily_row_count == counts.get("clean", 0)
    assert lake.quarantine().count() > 0
