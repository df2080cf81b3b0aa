"""Headline timings: prints one JSON line.

``BENCH_SF_DIR`` names the tables and ``BENCH_CPUS`` the cores. Two kinds of entries are timed: single
queries, whose whole result is computed and thrown away, and ``run_*`` steps, which take landing CSV
files of two batches through bronze and silver in a fresh store, all tables at once. A last run does
the same for ``BENCH_ORDERS`` generated orders. Rows per second count landed rows.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import time

from pyspark.sql import functions as F

from tidemark.operators.generate import feed
from tidemark.plans.bronze import ingest
from tidemark.plans.queries import build
from tidemark.plans.run import refine_all
from tidemark.retail import CUSTOMERS, ORDERS, RETAIL
from tidemark.session import build_session
from tidemark.sources.derived_feed import FIRST, SECOND, frame
from tidemark.sources.export import write_landing
from tidemark.sources.files import scratch
from tidemark.sources.store import Lake
from tidemark.spec import Batch

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
GENERATED_ORDERS = int(os.environ.get("BENCH_ORDERS", "1000000"))

QUERIES = [
    *[f"{t}_clean" for t in RETAIL],
    *[f"{t}_reject_counts" for t in RETAIL],
    *[f"{t}_duplicate_count" for t in RETAIL],
    "customers_history",
    "products_merged",
    "orders_merged",
    "order_items_merged",
    "payments_merged",
    "quarantine_rows",
    "order_items_with_date",
    "order_totals",
    "payments_from_items",
    "generated_order_items",
]


def timed(step) -> float:
    started = time.monotonic()
    step()
    return round(time.monotonic() - started, 3)


def compute(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def bench_queries(spark) -> dict[str, float]:
    known = build()
    return {name: timed(lambda n=name: compute(known[n](spark, SF_DIR))) for name in QUERIES}


def bench_runs(spark) -> tuple[dict[str, float], int, dict[str, float]]:
    """Two batches of the given tables, each with all tables at once; also each table's own seconds."""
    root = scratch(spark, "bench")
    lake = Lake(spark, f"{root}/lake")
    seconds: dict[str, float] = {}
    for batch in (FIRST, SECOND):
        n = batch.ingestion_id
        landing = f"{root}/landing_{n}"
        for spec in RETAIL.values():
            write_landing(spec, frame(spark, SF_DIR, spec.name, batch), landing)
        seconds[f"run_{n}_landing_to_bronze"] = timed(lambda: ingest(lake, landing, batch))
        seconds[f"run_{n}_bronze_to_silver"] = timed(lambda: refine_all(lake, batch, parallel=True))
    per_table = {
        f"run_{r['ingestion_id']}_{r['table_name']}": round(r["total_silver_process_executing_time"], 3)
        for r in lake.run_log().collect()
    }
    return seconds, sum(lake.bronze(s).count() for s in RETAIL.values()), per_table


def bench_generated(spark) -> tuple[dict[str, float], int, dict[str, float]]:
    """One larger run on generated landing files, all tables at once."""
    root = scratch(spark, "bench")
    landing = f"{root}/landing"
    tables = feed(spark, GENERATED_ORDERS // 5, GENERATED_ORDERS // 20, GENERATED_ORDERS)
    for spec in RETAIL.values():
        write_landing(spec, tables[spec.name], landing)
    lake = Lake(spark, f"{root}/lake")
    batch = Batch.at(1, dt.datetime(2026, 1, 1))
    seconds = {
        "generated_landing_to_bronze": timed(lambda: ingest(lake, landing, batch)),
        "generated_bronze_to_silver": timed(lambda: refine_all(lake, batch, parallel=True)),
    }
    rows = sum(lake.bronze_daily(s, 1).count() for s in RETAIL.values())
    return seconds, rows, merge_a_hundredth(lake, tables, f"{root}/landing_2")


def merge_a_hundredth(lake, tables, landing: str) -> dict[str, float]:
    """Changes of one row in a hundred, merged into main tables a hundred times as large."""
    chosen = {s.name: s for s in (ORDERS, CUSTOMERS)}
    for spec, column in ((ORDERS, "status"), (CUSTOMERS, "name")):
        some = tables[spec.name].filter(F.pmod(F.xxhash64(spec.key[0]), F.lit(100)) == 0)
        write_landing(spec, some.withColumn(column, F.lit("changed")), landing)
    batch = Batch.at(2, dt.datetime(2026, 1, 2))
    ingest(lake, landing, batch, chosen)
    merged = {}
    seconds = timed(lambda: merged.update(refine_all(lake, batch, chosen, parallel=True)))
    return {
        "seconds": seconds,
        "changed_rows": sum(m.updated + m.inserted for m in merged.values()),
        "main_rows": sum(m.main_rows for m in merged.values()),
    }


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    queries = bench_queries(spark)
    runs, rows, per_table = bench_runs(spark)
    generated, generated_rows, hundredth = bench_generated(spark)
    silver = sum(s for name, s in runs.items() if name.endswith("_to_silver"))
    every = queries | runs | generated
    print(
        json.dumps(
            {
                "metric": "all queries and three landing-to-silver runs",
                "value": round(sum(every.values()), 3),
                "unit": "sec",
                "queries": every,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                "bronze_to_silver_rows": rows,
                "bronze_to_silver_rows_per_sec": round(rows / silver),
                "logged_table_seconds": per_table,
                "generated_rows": generated_rows,
                "merge_of_one_percent": hundredth,
                "generated_bronze_to_silver_rows_per_sec": round(
                    generated_rows / generated["generated_bronze_to_silver"]
                ),
            }
        )
    )


if __name__ == "__main__":
    main()
