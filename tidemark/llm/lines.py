"""Line dedup: lines that many sites share are boilerplate, found by one mergeable sketch for each line."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, fresh, materialise, row_key, table

#: A line on so many sites is boilerplate.
MIN_SITES = 10
#: Registers of a sketch are 2 to this power.
LG_REGISTERS = 12
#: Standard errors around the threshold within which a sketch doesn't decide.
BAND = 5


def _band(min_sites: int, lg_registers: int) -> tuple[int, int]:
    margin = BAND * 1.04 / math.sqrt(2**lg_registers)
    return math.floor(min_sites * (1 - margin)), math.ceil(min_sites * (1 + margin))


def line_places(docs: DataFrame, doc_id: str, text: str, site: str) -> DataFrame:
    """One narrow row for each line that holds a word: the document's key, line number, line hash, site."""
    key = row_key(doc_id, text)
    lines = docs.select(
        F.col(doc_id).alias("_id"),
        key[0].alias("_key"),
        key[1].alias("_text"),
        F.col(site).alias("_site"),
        F.posexplode(F.split(text, "\n")),
    )
    return lines.where(F.col("col").rlike(f"[^{SPACE}]")).select(
        "_id", "_key", "_text", F.col("pos").alias("_at"), F.xxhash64("col").alias("_line"), "_site"
    )


def boilerplate(places: DataFrame, min_sites: int = MIN_SITES, lg_registers: int = LG_REGISTERS) -> DataFrame:
    """Hashes of the lines on at least ``min_sites`` sites, with the first place of each.

    A HyperLogLog sketch of the sites is kept for each line hash; partial sketches merge in the aggregation, so a line
    holding a third of all rows reaches the merge as one row per task. Estimates further than five standard errors from
    the threshold decide; the lines between are counted exactly.
    """
    low, high = _band(min_sites, lg_registers)
    place = F.struct(F.col("_id").isNull().alias("no_id"), F.col("_id").alias("id"), F.col("_at").alias("at"))
    sketch = F.hll_sketch_agg(F.col("_site").cast("string"), lg_registers)
    sketched = materialise(
        places.groupBy("_line")
        .agg(
            # Sketches leave null sites out.
            (F.hll_sketch_estimate(sketch) + F.max(F.col("_site").isNull().cast("int"))).alias("_sites"),
            F.min(place).alias("_first"),
        )
        .where(F.col("_sites") >= low),
        "line-sketches",
    )
    near = sketched.where(F.col("_sites") <= high).select("_line")
    exact = (
        places.join(near, "_line", "left_semi")
        .groupBy("_line", "_site")
        .agg(F.lit(1).alias("one"))
        .groupBy("_line")
        .agg(F.count("*").alias("_exact"))
        .where(F.col("_exact") >= min_sites)
    )
    sure = sketched.where(F.col("_sites") > high).select("_line", "_first")
    return sure.union(sketched.join(exact, "_line").select("_line", "_first"))


def without_boilerplate(
    docs: DataFrame,
    min_sites: int = MIN_SITES,
    keep_first: bool = True,
    doc_id: str = "doc_id",
    text: str = "text",
    site: str = "source",
    removed: str = "n_removed",
) -> DataFrame:
    """Every row of ``docs``, its text without boilerplate lines, and the number of lines removed.

    Lines are the parts between ``\\n``; those without a word stay. A line on ``min_sites`` distinct sites or more (a
    null site counts as one) stays only at its first place, by document id (null last) and line number; with
    ``keep_first=False`` nowhere. A null text stays null, a text whose lines all go becomes empty; no row is dropped.
    Rows that agree in id and text are one document here: each keeps the first place of a line. A column of the input
    named like ``removed`` is replaced.
    """
    places = materialise(line_places(docs, doc_id, text, site), "line-places")
    hit = places.join(boilerplate(places, min_sites), "_line")
    if keep_first:
        first = F.struct(F.col("_id").isNull().alias("no_id"), F.col("_id").alias("id"), F.col("_at").alias("at"))
        hit = hit.where(~first.eqNullSafe(F.col("_first")))
    gone, row_id, row_text, lines = fresh(docs, "_gone", "_row_id", "_row_text", "_lines")
    by_row = hit.groupBy("_key", "_text").agg(F.collect_set("_at").alias(gone))
    by_row = by_row.select(F.col("_key").alias(row_id), F.col("_text").alias(row_text), gone)
    key = row_key(doc_id, text)
    joined = docs.join(by_row, (key[0] == F.col(row_id)) & (key[1] == F.col(row_text)), "left").select("*", F.when(F.col(gone).isNotNull(), F.split(text, "\n")).alias(lines))
    stays = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    rest = F.array_join(F.transform(stays, lambda i: F.get(lines, i)), "\n")
    whole = F.when(F.col(gone).isNull(), F.col(text)).otherwise(rest)
    return joined.select(
        *[whole.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns if c.lower() != removed.lower()],
        F.coalesce(F.size(gone), F.lit(0)).cast("long").alias(removed),
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return without_boilerplate(docs).select("doc_id", "text", "n_removed")


OP4_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text, source FROM documents),
p AS (SELECT rid, doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS ln FROM d),
w AS (SELECT * FROM p WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
b AS (SELECT line, min((doc_id IS NULL, doc_id, ln)) AS f FROM w GROUP BY line
      HAVING count(DISTINCT source) + max((source IS NULL)::INT) >= {MIN_SITES}),
m AS (SELECT p.*, b.line IS NOT NULL AND (p.doc_id IS NULL, p.doc_id, p.ln) IS DISTINCT FROM b.f AS gone FROM p LEFT JOIN b ON p.line = b.line),
t AS (SELECT rid, coalesce(string_agg(line, chr(10) ORDER BY ln) FILTER (NOT gone), '') AS rest, count(*) FILTER (gone) AS n FROM m GROUP BY rid)
SELECT d.doc_id, CASE WHEN n > 0 THEN rest ELSE text END AS text, coalesce(n, 0)::BIGINT AS n_removed FROM d LEFT JOIN t USING (rid)
"""
