"""SimHash near-dedup: fingerprints compared as vertical bit planes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import components, materialise, row_key, table

BITS = 64
SHINGLE = 4
RADIUS = 4
#: Parts of a fingerprint: of six, a pair within four bits has two untouched.
PARTS = 6
#: Rows of a bucket that are compared at once; larger buckets are compared in pairs of such pieces.
PIECE = 8192
#: Shingles hashed at once, so very long texts need bounded memory.
HASHED = 1 << 16


def fingerprint(words: list[bytes], size: int = SHINGLE) -> int:
    """SimHash of the shingles of a text, as a signed long; a text without words has zero."""
    n = max(1, len(words) - size + 1) if len(words) else 0
    ones = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, HASHED):
        hashes = np.fromiter(
            (digest(b" ".join(words[i : i + size]), 42) for i in range(at, min(n, at + HASHED))), dtype="<u8"
        )
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def _fingerprints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        # Bytes lower A-Z only, and split at space and U+0009 to U+000D only.
        words = (text.lower().split() for text in batch.pop("text"))
        yield batch.assign(fp=np.fromiter(map(fingerprint, words), dtype=np.int64, count=len(batch)))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text_hash, fp) of every row. Null and empty texts have no words and the fingerprint zero."""
    texts = docs.select(
        F.col(doc_id).alias("id"),
        row_key(doc_id, text)[1].alias("text_hash"),
        F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"),
    )
    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInPandas(_fingerprints, f"id {kind}, text_hash long, fp long")


def buckets(prints: DataFrame, parts: int = PARTS, radius: int = RADIUS) -> DataFrame:
    """(fp, bucket): one row for each choice of parts of which a pair within the radius shares at least one.

    The bucket is the choice's number and the bits of its parts, hashed; fingerprints are split in parts of equal size.
    """
    width = -(-BITS // parts)
    slices = [
        F.shiftrightunsigned("fp", i * width).bitwiseAND(F.lit((1 << min(width, BITS - i * width)) - 1)) for i in range(parts)
    ]
    choices = [
        F.xxhash64(F.lit(n), *[slices[i] for i in chosen])
        for n, chosen in enumerate(combinations(range(parts), parts - radius))
    ]
    return prints.select("fp", F.explode(F.array(*choices)).alias("bucket"))


def _forest(rows: int, pairs: Iterable[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The root of each row: pairs come in batches, only those between different trees cost a step."""
    root = np.arange(rows)
    for a, b in pairs:
        apart = root[a] != root[b]
        if not apart.any():
            continue
        up = root.tolist()
        for x, y in zip(a[apart].tolist(), b[apart].tolist()):
            while up[x] != x:
                x = up[x]
            while up[y] != y:
                y = up[y]
            if x != y:
                up[max(x, y)] = min(x, y)
        root = np.array(up)
        while not np.array_equal(root, above := root[root]):
            root = above
    return root


def _within(planes: list[np.ndarray], others: list[np.ndarray], radius: int) -> np.ndarray:
    """Bits set where column i of ``planes`` and of ``others`` differ in at most ``radius`` planes.

    A word holds one plane of 64 fingerprints. Differences are added in ones, twos and fours by carry-save steps, and
    whatever passes seven is remembered as over. Words whose 64 columns have all passed the radius leave the comparison.
    """
    out = np.zeros_like(planes[0])
    left = np.arange(len(out))
    ones, twos, fours, over = (np.zeros_like(out) for _ in range(4))
    every = ~np.uint64(0)
    for n, (p, q) in enumerate(zip(planes, others)):
        carry = p[left] ^ q[left]
        ones, carry = ones ^ carry, ones & carry
        twos, carry = twos ^ carry, twos & carry
        fours, carry = fours ^ carry, fours & carry
        over = over | carry
        if n % 4 == 3 and n > radius:
            open_ = _passed(ones, twos, fours, over, radius) != every
            if not open_.all():
                left, ones, twos, fours, over = left[open_], ones[open_], twos[open_], fours[open_], over[open_]
                if not len(left):
                    return out
    out[left] = ~_passed(ones, twos, fours, over, radius)
    return out


def _passed(ones: np.ndarray, twos: np.ndarray, fours: np.ndarray, over: np.ndarray, radius: int) -> np.ndarray:
    """Columns whose count exceeds the radius, a number under eight: count > radius, bit by bit from the top."""
    more, same = over.copy(), ~over
    for bit, counter in ((4, fours), (2, twos), (1, ones)):
        if radius & bit:
            same = same & counter
        else:
            more, same = more | (same & counter), same & ~counter
    return more


def _planes(fps: np.ndarray) -> list[np.ndarray]:
    """Bit planes of fingerprints, 64 of them in a word; the last word is filled up with zeros."""
    full = np.zeros(-(-len(fps) // 64) * 64, dtype="<u8")
    full[: len(fps)] = fps.view("<u8")
    bits = np.unpackbits(full.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return [np.packbits(np.ascontiguousarray(bits[:, k]), bitorder="little").view("<u8") for k in range(BITS)]


def _close_pairs(fps: np.ndarray, runs: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one run within the radius. ``runs``: the length of each run of rows of one bucket.

    All rows are compared with the row ``lag`` places on at the same time, for each lag that a run is long enough for.
    """
    rest = np.repeat(runs, runs) - np.concatenate([np.arange(n) for n in runs]) if len(runs) else np.zeros(0, int)
    at = np.arange(len(fps))
    for lag in range(1, int(runs.max(initial=1))):
        at = at[rest[at] > lag]  # rows that have a partner in their run this far on
        if not len(at):
            return
        near = _within(_planes(fps[at]), _planes(fps[at + lag]), radius)
        hit = np.flatnonzero(np.unpackbits(near.view(np.uint8), bitorder="little")[: len(at)])
        if len(hit):
            yield at[hit], at[hit] + lag


def _linked(fps: np.ndarray, buckets_: np.ndarray, radius: int) -> pd.DataFrame:
    """Links of a spanning forest of rows that are in order of their bucket."""
    starts = np.flatnonzero(np.r_[True, buckets_[1:] != buckets_[:-1]]) if len(fps) else np.zeros(0, int)
    runs = np.diff(np.r_[starts, len(fps)])
    keep = np.repeat(runs > 1, runs)
    fps, runs = fps[keep], runs[runs > 1]
    root = _forest(len(fps), _close_pairs(fps, runs, radius))
    far = root != np.arange(len(fps))
    return pd.DataFrame({"a": fps[far], "b": fps[root[far]]})


def _stream(batches: Iterator[pd.DataFrame], radius: int, rows: int) -> Iterator[pd.DataFrame]:
    """Links within the buckets of a partition in order of buckets; a bucket is never torn apart."""
    held: list[pd.DataFrame] = []
    count = 0
    for batch in batches:
        if not len(batch):
            continue
        if count >= rows:
            # Whole buckets only: what has the bucket of the last row waits for more.
            done = pd.concat(held)
            key = done["bucket"].to_numpy()
            cut = int(np.flatnonzero(key != key[-1])[-1]) + 1 if (key != key[-1]).any() else 0
            if cut:
                yield _linked(done["fp"].to_numpy()[:cut], key[:cut], radius)
            held = [done.iloc[cut:]]
            count = len(done) - cut
        held.append(batch)
        count += len(batch)
    if held:
        done = pd.concat(held)
        yield _linked(done["fp"].to_numpy(), done["bucket"].to_numpy(), radius)


def links(prints: DataFrame, radius: int = RADIUS, piece: int = PIECE) -> DataFrame:
    """(a, b): links between distinct fingerprints within the radius, a spanning forest of each bucket.

    Buckets of more than ``piece`` rows are cut into pieces that are compared two by two, so no task gets more than
    twice that of one bucket. ``prints`` must hold each fingerprint once.
    """
    if not 0 <= radius < PARTS:
        raise ValueError(f"radius must be from 0 to {PARTS - 1}")
    rows = buckets(prints, radius=radius)
    large = rows.groupBy("bucket").count().where(F.col("count") > piece)
    pieces = F.ceil(F.col("count") / piece).cast("int")
    cut = rows.join(large, "bucket", "left").select(
        "fp", "bucket", F.coalesce(pieces, F.lit(1)).alias("n"), F.pmod(F.xxhash64("fp", F.lit(7)), F.coalesce(pieces, F.lit(1))).cast("int").alias("i")
    )
    # With one piece a bucket stays as it is; of n pieces every pair meets once.
    spread = cut.select(
        "fp",
        F.explode(
            F.when(F.col("n") == 1, F.array("bucket")).otherwise(
                F.transform(
                    F.sequence(F.lit(0), F.col("n") - 1),
                    lambda j: F.xxhash64("bucket", F.least("i", j), F.greatest("i", j)),
                )
            )
        ).alias("bucket"),
    )
    ordered = spread.repartition("bucket").sortWithinPartitions("bucket")
    return ordered.mapInPandas(lambda batches: _stream(batches, radius, 1 << 18), "a long, b long")


def _first_of_prints(rows: DataFrame, radius: int) -> DataFrame:
    """(fp, first): for each fingerprint the first (id, text_hash) of its component."""
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")
    prints = materialise(rows.groupBy("fp").agg(F.min(place).alias("first")), "simhash-prints")
    roots = components(materialise(links(prints.select("fp"), radius), "simhash-links"), "simhash")
    rooted = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    best = rooted.groupBy("root").agg(F.min("first").alias("first"))
    return rooted.select("fp", "root").join(best, "root").select("fp", "first")


def classes(docs: DataFrame, radius: int = RADIUS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fp, component_id) of every row; ``component_id`` is the smallest id in the row's component.

    Fingerprints that differ in at most ``radius`` bits are linked, equal ones included, also those of null, empty and
    blank texts, which are zero. Null ids come last: a component has a null id only if it has no other. Rows that
    repeat are rows of one component, an empty table gives an empty result, and other columns of ``docs`` aren't read.
    """
    rows = materialise(fingerprints(docs, doc_id, text), "simhash-rows")
    return rows.join(_first_of_prints(rows, radius), "fp").select("id", "fp", F.col("first.id").alias("component_id"))


def one_of_each(docs: DataFrame, radius: int = RADIUS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The first row of each component, with the columns of ``docs``: the smallest id, null last, then by hash of the text.

    Of rows that agree in id and text one stays.
    """
    rows = materialise(fingerprints(docs, doc_id, text), "simhash-rows")
    first = _first_of_prints(rows, radius).select("first").distinct()
    return kept_rows(docs, first, doc_id, text)


def kept_rows(docs: DataFrame, first: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The rows of ``docs`` that ``first`` names by (id, text_hash), one for each name."""
    stays = first.select(F.col("first.id").alias("stay"), F.col("first.text_hash").alias("text_hash"))
    stays = stays.select(F.coalesce(F.col("stay").cast("string"), F.lit("")).alias("_id"), F.col("text_hash").alias("_text"))
    key = row_key(doc_id, text)
    inner = docs.select(F.struct("*").alias("row"), key[0].alias("_id"), key[1].alias("_text"))
    # Rows that agree in id and text are one per task before they are dealt out, however many they are.
    return inner.dropDuplicates(["_id", "_text"]).join(stays, ["_id", "_text"], "left_semi").select("row.*")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return classes(docs).select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        (F.col("id") == F.col("component_id")).alias("kept"),
    )
