"""Mixing sources to target weights: equal blocks of words, given out by highest quotients."""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, WORD, materialise, row_key, running_total, table

#: Words of a block.
BLOCK = 16
#: Parts of a source that get whole numbers of blocks of their own, and the words below which a source is one part.
SHARDS, WHOLE = 8, 2048
#: No source is taken more often than this.
REPEATS = 3
WEIGHTS = (5, 2, 1)
#: Sources are a configured list: their totals, eight numbers each, are worked out on the driver.
MOST_SOURCES = 100_000


def targets(sizes: Sequence[int], weights: Sequence[int], total: int, repeats: int = REPEATS) -> list[float]:
    """Shares of ``total`` by weight, none above ``repeats`` times its size; what is above is shared again."""
    out, left, open_ = [0.0] * len(sizes), Fraction(total), [i for i, n in enumerate(sizes) if n > 0]
    while open_:
        level = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if level * weights[i] > repeats * sizes[i]]
        if not full:
            for i in open_:
                out[i] = float(level * weights[i])
            break
        for i in full:
            out[i] = float(repeats * sizes[i])
            left -= repeats * sizes[i]
        open_ = [i for i in open_ if i not in set(full)]
    return out


def sainte_lague(weights: Sequence[float], seats: int, most: Sequence[int]) -> list[int]:
    """Seats by the highest quotients weight / (2 n + 1), at most ``most`` each; equal quotients go to the earlier one.

    All quotients above a divisor that leaves few seats over are given out at once, the rest one by one.
    """
    whole, n = sum(map(Fraction, weights)), len(weights)
    given = [0] * n
    if seats > n and whole:
        divisor = whole / (seats - Fraction(n, 2))
        # A weight has passed every quotient over half the divisor: its own share, rounded, halves down.
        given = [min(m, max(0, -((-2 * Fraction(w) / divisor + 1) // 2))) for w, m in zip(weights, most)]
    queue = [(-Fraction(w) / (2 * g + 1), i) for i, (w, g, m) in enumerate(zip(weights, given, most)) if g < m and w > 0]
    heapq.heapify(queue)
    left = seats - sum(given)
    while left > 0 and queue:
        _, i = heapq.heappop(queue)
        given[i] += 1
        left -= 1
        if given[i] < most[i]:
            heapq.heappush(queue, (-Fraction(weights[i]) / (2 * given[i] + 1), i))
    return given


def _start(seed: int, source: str | None, shard: int, size: int) -> int:
    """The seeded word of a part at which its first block begins."""
    name = f"{seed}:{shard}:{'' if source is None else 's' + source}"
    return int(hashlib.md5(name.encode()).hexdigest()[:8], 16) % size if size else 0


def mixed(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    block: int = BLOCK,
    shards: int = SHARDS,
    seed: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """One row for each row of ``docs``: id, text_hash, source, size, source_size, target, from, until, head, full, taken.

    Sources in order of code points, null last, take the weights in turn and share all words. Blocks of ``block`` words
    go to sources by Sainte-Laguë quotients of their targets, and a source's blocks to its shards by quotients of their
    sizes; sources of few words are one shard. A shard's documents stand in an order seeded by their id; its blocks are laid end to end from a seeded word
    on, round and round, so that all but two documents of a shard are taken whole, ``taken`` words each. ``full`` is how
    often the whole document is taken; besides, its words ``from`` to ``until`` (counted from zero) and its first
    ``head`` ones are.

    Null and empty texts have no words and none is taken. Rows that agree in id and size may swap places, which gives
    the same rows. An empty table gives an empty result; other columns aren't read.
    """
    spark = docs.sparkSession
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))).cast("binary"))
    rows = materialise(
        docs.select(
            F.col(doc_id).alias("id"),
            row_key(doc_id, text)[1].alias("text_hash"),
            F.col(source).cast("string").alias("source"),
            F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            key.alias("key"),
        )
        .withColumn("nowhere", F.col("source").isNull())
        .withColumn("shard", F.pmod(F.conv(F.substring("key", 1, 4), 16, 10).cast("int"), F.lit(shards))),
        "mix-rows",
    )
    found = rows.groupBy("nowhere", "source", "shard").agg(F.sum("size").alias("n")).limit(MOST_SOURCES * shards + 1).collect()
    if len(found) > MOST_SOURCES * shards:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    cells = {(r["nowhere"], r["source"] or "", r["shard"]): r["n"] for r in found}
    names = sorted({k[:2] for k in cells}, key=lambda k: (k[0], k[1].encode()))
    sizes = [sum(cells.get((*name, k), 0) for k in range(shards)) for name in names]
    wanted = targets(sizes, [weights[i % len(weights)] for i in range(len(names))], sum(sizes))
    # The last block of a part may be a part of one, so what is taken at most is a number of words, not of blocks.
    most = lambda n: -(-REPEATS * n // block)
    quotas = sainte_lague(wanted, round(sum(sizes) / block), [most(n) for n in sizes])
    plan = []
    for name, size, target, quota in zip(names, sizes, wanted, quotas):
        parts = [cells.get((*name, k), 0) for k in range(shards)] if size >= WHOLE else [size]
        for k, got in enumerate(sainte_lague(parts, quota, [most(n) for n in parts])):
            words = min(got * block, REPEATS * parts[k])
            at = _start(seed, None if name[0] else name[1], k, parts[k])
            plan.append((*name, k, size < WHOLE, parts[k], size, target, words // max(1, parts[k]), words % max(1, parts[k]), at))
    schema = "nowhere boolean, name string, part int, single boolean, cell long, source_size long, target double, rounds long, rest long, at long"
    # One row for each shard of a source: bounded by MOST_SOURCES.
    plan_ = F.broadcast(spark.createDataFrame(plan, schema))
    placed = running_total(rows, ["nowhere", "source", "shard", "key", "id", "size", "text_hash"], "size", "mix-order")
    same = (
        (placed["nowhere"] == plan_["nowhere"])
        & (F.coalesce(placed["source"], F.lit("")) == plan_["name"])
        & (plan_["single"] | (placed["shard"] == plan_["part"]))
    )
    starts = placed.groupBy("nowhere", "source", "shard").agg(F.min("before").alias("first"))
    # Shards of a source that is one part follow each other, so it begins where the first of them does.
    whole = Window.partitionBy("nowhere", "source")
    starts = starts.withColumn("low", F.min("first").over(whole))
    starts = F.broadcast(
        starts.select(F.col("nowhere").alias("w"), F.coalesce("source", F.lit("")).alias("s"), F.col("shard").alias("k"), "first", "low")
    )
    here = (F.col("w") == placed["nowhere"]) & (F.col("s") == F.coalesce(placed["source"], F.lit(""))) & (F.col("k") == placed["shard"])
    first = F.when(F.col("single"), F.col("low")).otherwise(F.col("first"))
    a = F.col("before") - first
    # The rest of the blocks is the cyclic run of words [at, at + rest) of the shard: after ``at``, and from zero on.
    upto = F.col("at") + F.col("rest")
    tail = F.least(F.greatest(F.col("at") - F.col("a"), F.lit(0)), F.col("size"))
    until = F.least(F.greatest(upto - F.col("a"), F.lit(0)), F.col("size"))
    wrapped = F.least(F.greatest(upto - F.col("cell") - F.col("a"), F.lit(0)), F.col("size"))
    out = (
        placed.join(plan_, same)
        .join(starts, here)
        .select("id", "text_hash", placed["source"], "size", "cell", "source_size", "target", "rounds", "rest", "at", a.alias("a"))
        .select("*", tail.alias("from"), until.alias("until"), wrapped.alias("head"))
    )
    return out.select(
        "id", "text_hash", "source", "size", "source_size", "target", "from", "until", "head",
        F.col("rounds").alias("full"),
        (F.col("rounds") * F.col("size") + F.col("until") - F.col("from") + F.col("head")).alias("taken"),
    )


def drawn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each time a document is taken, whole or in part.

    Where a shard's blocks begin or end inside a document its text is cut between words, with the white space before
    the words that stay. Documents of which no word is taken go.
    """
    plan = mixed(docs, doc_id=doc_id, text=text, **settings)
    # Rows that agree in id and text are told apart by a number.
    same = Window.partitionBy("_id", "_text")
    span = lambda i, j: F.struct(i.cast("long").alias("i"), j.alias("j"))
    pieces = F.concat(
        F.array_repeat(span(F.lit(0), F.col("size")), F.col("full").cast("int")),
        F.array(span(F.col("from"), F.col("until")), span(F.lit(0), F.col("head"))),
    )
    plan = plan.select(
        F.coalesce(F.col("id").cast("string"), F.lit("")).alias("_id"),
        F.col("text_hash").alias("_text"),
        "size",
        F.filter(pieces, lambda p: p["i"] < p["j"]).alias("pieces"),
    )
    plan = plan.withColumn("_n", F.row_number().over(same.orderBy("pieces"))).where(F.size("pieces") > 0)
    key = row_key(doc_id, text)
    inner = docs.select(F.struct("*").alias("row"), key[0].alias("_id"), key[1].alias("_text"))
    inner = inner.withColumn("_n", F.row_number().over(same.orderBy(F.lit(0))))
    # The number is a join key, so rows that agree are joined one to one and never with each other.
    joined = inner.join(plan, ["_id", "_text", "_n"])
    each = joined.select("row", "size", F.explode("pieces").alias("p"))
    words = F.regexp_extract_all(F.col(f"row.{text}"), F.lit(rf"[{SPACE}]*{WORD}"), F.lit(0))
    cut = F.array_join(F.slice(words, (F.col("p.i") + 1).cast("int"), (F.col("p.j") - F.col("p.i")).cast("int")), "")
    new = F.when((F.col("p.i") == 0) & (F.col("p.j") == F.col("size")), F.col(f"row.{text}")).otherwise(cut)
    return each.select(*[new.alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixed(docs).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


#: The same in SQL: seats are ranked one by one here.
OP10_SQL = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
             md5('1:' || coalesce(doc_id::VARCHAR, 'null')) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS n, row_number() OVER (ORDER BY source NULLS LAST) AS r FROM d GROUP BY source),
k AS (SELECT d.*, ('0x' || substr(key, 1, 4))::INT % {SHARDS} AS h, CASE WHEN n < {WHOLE} THEN 0 ELSE h END AS shard
      FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
w AS (SELECT *, [5, 2, 1][(r - 1) % 3 + 1] AS weight, sum(n) OVER ()::BIGINT AS total FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY n / weight, r) AS q FROM w WHERE n > 0),
l AS (SELECT *, total - coalesce(sum({REPEATS} * n) OVER (ORDER BY q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
        sum(weight) OVER (ORDER BY q ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open FROM o),
c AS (SELECT min(q) AS q FROM l WHERE rest::DOUBLE * weight / open <= {REPEATS} * n),
t AS (SELECT l.source, n, r, total, CASE WHEN l.q < c.q THEN ({REPEATS} * n)::DOUBLE
        ELSE (SELECT rest * l.weight FROM l x WHERE x.q = c.q)::DOUBLE / (SELECT open FROM l x WHERE x.q = c.q) END AS target FROM l, c),
seats AS (SELECT source, r, target / (2 * unnest(range(0, ({REPEATS} * n + {BLOCK} - 1) // {BLOCK})) + 1) AS quotient, total FROM t),
taken AS (SELECT source, r FROM seats QUALIFY row_number() OVER (ORDER BY quotient DESC, r) <= round_even(total / {BLOCK}, 0)),
quota AS (SELECT source, count(*) AS seats FROM taken GROUP BY source),
cells AS (SELECT source, shard, sum(size)::BIGINT AS cell FROM k GROUP BY source, shard),
inner_ AS (SELECT source, shard, cell, cell / (2 * unnest(range(0, ({REPEATS} * cell + {BLOCK} - 1) // {BLOCK})) + 1) AS quotient FROM cells),
won AS (SELECT i.source, i.shard, cell FROM inner_ i JOIN quota q ON i.source IS NOT DISTINCT FROM q.source
        QUALIFY row_number() OVER (PARTITION BY i.source ORDER BY quotient DESC, shard) <= q.seats),
got AS (SELECT source, shard, least(count(*) * {BLOCK}, {REPEATS} * max(cell)) AS words FROM won GROUP BY source, shard),
plan AS (SELECT c.source, c.shard, cell, coalesce(words, 0) AS words,
        CASE WHEN cell > 0 THEN ('0x' || substr(md5('1:' || c.shard || ':' || coalesce('s' || c.source, '')), 1, 8))::BIGINT % cell ELSE 0 END AS start
        FROM cells c LEFT JOIN got g ON c.source IS NOT DISTINCT FROM g.source AND c.shard = g.shard),
p AS (SELECT k.*, cell, words, start, coalesce(sum(size) OVER (PARTITION BY k.source, k.shard ORDER BY h, key, doc_id, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a
      FROM k JOIN plan ON k.source IS NOT DISTINCT FROM plan.source AND k.shard = plan.shard),
f AS (SELECT *, CASE WHEN cell > 0 THEN words // cell ELSE 0 END AS rounds, CASE WHEN cell > 0 THEN words % cell ELSE 0 END AS rest FROM p)
SELECT doc_id, size, s.n AS source_size, coalesce(t.target, 0.0) AS target,
  (rounds * size + least(greatest(start + rest - a, 0), size) - least(greatest(start - a, 0), size)
    + least(greatest(start + rest - cell - a, 0), size))::BIGINT AS taken
FROM f JOIN s ON f.source IS NOT DISTINCT FROM s.source LEFT JOIN t ON f.source IS NOT DISTINCT FROM t.source
"""
