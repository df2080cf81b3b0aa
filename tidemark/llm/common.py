"""What several operators share: words, written intermediates, running totals, linked components."""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.sources.files import scratch

#: White space is space and U+0009 to U+000D; a word is a longest run of anything else.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"
#: The most new names a round of ``components`` may need before it stops looking for more.
ROUNDS = 60


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def split_words(text: Column) -> Column:
    """The words of a text; none for a null one."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends, and every reader sees the same rows."""
    path = scratch(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow_words(texts: pa.Array, table: bytes) -> tuple[pa.Array, np.ndarray]:
    """Words of all binary texts behind each other, and how many each text has; inside tasks, without an object for each word.

    Bytes are replaced by ``table`` first, and words stand between white space. Null texts have none.
    """
    # Taken, as Arrow lower-cases and splits slices of larger arrays at wrong places.
    texts = texts.cast(pa.binary()).fill_null(b"").take(pa.array(np.arange(len(texts))))
    _, offsets, data = texts.buffers()
    data = pa.py_buffer((data.to_pybytes() if data else b"").translate(table))
    lists = pc.ascii_split_whitespace(pa.Array.from_buffers(pa.string(), len(texts), [None, offsets, data]))
    words = lists.flatten().view(pa.binary())
    # White space at the ends of a text leaves empty words.
    real = pc.greater(pc.binary_length(words), 0)
    before = np.r_[0, np.cumsum(real.to_numpy(zero_copy_only=False))]
    ends = lists.offsets.to_numpy()
    return words.filter(real).cast(pa.large_binary()), np.diff(before[ends - ends[0]])


def joined(words: pa.Array) -> bytes:
    """Words with a space between each two."""
    return pc.binary_join(pa.LargeListArray.from_arrays([0, len(words)], words), pa.scalar(b" ", words.type))[0].as_py()


def coded(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Each word's place among the sorted different ones, and these."""
    found = words.dictionary_encode()
    order = pc.sort_indices(found.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    return rank[found.indices.to_numpy()], found.dictionary.take(order)


def distinct_of(numbers: np.ndarray) -> np.ndarray:
    """The different numbers, in order. Sorted, as numpy's own way hashes them, which takes many times as long."""
    numbers = np.sort(numbers)
    return numbers[np.diff(numbers, prepend=numbers[:1] - 1) != 0]


def row_key(doc_id: str, text: str) -> tuple[Column, Column]:
    """Two columns, never null, that tell rows with other ids or texts apart; for joins back to whole rows."""
    return F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.xxhash64(F.col(doc_id).isNull(), F.col(text))


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Helper column names that the frame does not hold already, whatever their case."""
    held = {c.lower() for c in df.columns}
    names = []
    for name in wanted:
        while name.lower() in held:
            name = f"_{name}"
        held.add(name.lower())
        names.append(name)
    return names


def running_total(df: DataFrame, order: list[str], size: str, purpose: str, out: str = "before") -> DataFrame:
    """Add ``out``: the sum of ``size`` over all rows that come earlier in the order of ``order``.

    A distributed prefix sum. Rows are dealt out by ranges of the order and written, each range is summed, and the
    sums of the ranges (one row for each partition, so their broadcast is bounded by the number of partitions) are
    added to a running sum within each range. Rows equal in all of ``order`` must be interchangeable.
    """
    placed = materialise(
        df.repartitionByRange(*[F.col(c) for c in order]).withColumn("_range", F.spark_partition_id()), purpose
    )
    sums = placed.groupBy("_range").agg(F.sum(size).alias("_sum"))
    ranges = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_range", F.coalesce(F.sum("_sum").over(ranges), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.withColumn("_inside", F.coalesce(F.sum(size).over(inside), F.lit(0)))
        .join(F.broadcast(offsets), "_range")
        .withColumn(out, F.col("_inside") + F.col("_offset"))
        .drop("_inside", "_offset", "_range")
    )


def components(edges: DataFrame, purpose: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b): nodes have one root exactly if links connect them.

    Contraction: each round every node points at the neighbour, or itself, that comes first in a hashed order; edges
    are renamed to what their ends point at, and the rest is contracted again. Hashing makes long chains shrink by a
    constant factor a round, and the minimum is pre-aggregated, so a node with very many links is one row per task.
    Every round is written to the shared folder. No link and no component reaches the driver, only counts do.
    """
    rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))
    left = materialise(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        f"{purpose}-edges",
    )
    steps = []
    while not left.isEmpty():
        if len(steps) == ROUNDS:
            raise RuntimeError("components did not converge")
        both = left.select("a", "b").union(left.select("b", "a"))
        points = materialise(
            both.groupBy(F.col("a").alias("node"))
            .agg(F.min(rank("b")).alias("best"))
            .select("node", F.least(rank("node"), F.col("best"))["v"].alias("to")),
            f"{purpose}-points",
        )
        steps.append(points)
        ends = {c: points.select(F.col("node").alias(c), F.col("to").alias(f"{c}2")) for c in ("a", "b")}
        renamed = left.join(ends["a"], "a").join(ends["b"], "b").where("a2 <> b2")
        left = materialise(
            renamed.select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct(),
            f"{purpose}-edges",
        )
    if not steps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    # What a node points at is either in the next round or the last of its component.
    found = steps[-1].select("node", F.col("to").alias("root"))
    for points in reversed(steps[:-1]):
        later = found.select(F.col("node").alias("to"), "root")
        found = points.join(later, "to", "left").select("node", F.coalesce("root", "to").alias("root"))
    return materialise(found, f"{purpose}-roots")
