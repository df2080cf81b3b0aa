"""Periodic run detection: longest common extensions over a difference cover drive a search on harmonic grids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import fresh, split_words, table

#: Fixed value: a perfect difference set. Every number from 1 to 30 is a difference of two of its members modulo 31.
COVER, MODULUS = (0, 1, 3, 8, 12, 18), 31
#: A run has so many words, and so many periods, at least.
LEAST, TIMES = 6, 4
#: Words of the texts that are searched together, places of the grid that are looked at at once, and rows passed on at once.
WORDS, PLACES, ROWS = 1 << 17, 1 << 20, 500

_SLOT = np.full(MODULUS, -1, dtype=np.int64)
_SLOT[list(COVER)] = np.arange(len(COVER))


def _steps() -> np.ndarray:
    """For the residues of two positions the fewest words on which both are in the cover."""
    out = np.empty((MODULUS, MODULUS), dtype=np.int64)
    for i in range(MODULUS):
        for j in range(MODULUS):
            out[i, j] = next(h for h in range(MODULUS) if _SLOT[(i + h) % MODULUS] >= 0 and _SLOT[(j + h) % MODULUS] >= 0)
    return out


_STEPS = _steps()


class Extensions:
    """Longest common extensions of positions in one sequence of numbers.

    Only suffixes that begin in the cover are sorted. Two positions are compared word by word until both are in it,
    after fewer words than the modulus; from there on the answer is the least of the common prefixes between their
    places in the sorted order, which a sparse table gives at once. A number that occurs once ends every extension.
    """

    def __init__(self, ids: np.ndarray):
        n = len(ids)
        blocks = n // MODULUS + 2
        # What follows the end are numbers of their own, so no two suffixes are alike.
        top = int(ids.max(initial=0)) + 1
        self.ids = np.concatenate([ids, np.arange(top, top + (blocks + 2) * MODULUS - n)])
        self.at = (np.arange(blocks)[:, None] * MODULUS + np.array(COVER)).ravel()
        levels = self._sort()
        self._common(levels)

    def _sort(self) -> list[np.ndarray]:
        """Ranks of the sampled suffixes; returns what they were by 31, 62, 124 ... words."""
        m = len(self.at)
        key = self.ids[self.at]
        order = np.argsort(key, kind="stable")
        rank = np.empty(m, dtype=np.int64)
        tied = self._ranked(rank, order, np.r_[True, key[order][1:] != key[order][:-1]], np.arange(m))
        depth, levels = 1, []
        while len(tied):
            if depth < MODULUS:
                here = self.at[tied] + depth
                more = min(2, MODULUS - depth)
                key = self.ids[here] << 31
                key += self.ids[here + 1] if more == 2 else 0
                depth += more
            else:
                levels.append(rank.copy())
                key = levels[-1][np.minimum(tied + depth // MODULUS * len(COVER), m - 1)]
                depth *= 2
            by = np.lexsort((key, rank[tied]))
            held, key, old = tied[by], key[by], rank[tied[by]]
            first = np.r_[True, (key[1:] != key[:-1]) | (old[1:] != old[:-1])]
            # Places of a group begin at its old rank.
            group = np.r_[True, old[1:] != old[:-1]]
            start = np.maximum.accumulate(np.where(group, np.arange(len(held)), 0))
            tied = self._ranked(rank, held, first, old + np.arange(len(held)) - start)
        self.rank = rank
        return levels

    @staticmethod
    def _ranked(rank: np.ndarray, order: np.ndarray, first: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Give each of ``order`` the place of the first of its equals; returns those that have equals."""
        starts = np.flatnonzero(first)
        sizes = np.diff(np.r_[starts, len(order)])
        rank[order] = np.repeat(place[starts], sizes)
        return order[np.repeat(sizes > 1, sizes)]

    def _common(self, levels: list[np.ndarray]) -> None:
        """The common prefixes of neighbours in the sorted order, and the minima of all their stretches of 1, 2, 4 ..."""
        order = np.empty(len(self.rank), dtype=np.int64)
        order[self.rank] = np.arange(len(order))
        x, y = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(x), dtype=np.int64)
        for k in reversed(range(len(levels))):
            same = levels[k][x] == levels[k][y]
            common += same * (MODULUS << k)
            x += same * (len(COVER) << k)
            y += same * (len(COVER) << k)
        common += self._compared(self.at[x], self.at[y], np.full(len(x), MODULUS))[0]
        self.least = [common.astype(np.int32)]
        while len(self.least[-1]) > 1 << len(self.least) - 1:
            last, width = self.least[-1], 1 << len(self.least) - 1
            self.least.append(np.minimum(last[:-width], last[width:]))

    def _compared(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Equal words from both positions on, at most ``most``, and which pairs came so far."""
        out, live = np.zeros(len(i), dtype=np.int64), np.arange(len(i))
        passed, n = np.zeros(len(i), dtype=bool), 0
        while len(live):
            done = most[live] == n
            if done.any():
                passed[live[done]] = True
                live = live[~done]
            live = live[self.ids[i[live] + n] == self.ids[j[live] + n]]
            n += 1
            out[live] = n
        return out, passed

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For each two positions the number of equal words from them on."""
        step = _STEPS[i % MODULUS, j % MODULUS]
        out, far = self._compared(i, j, step)
        i, j = i[far] + step[far], j[far] + step[far]
        a, b = (self.rank[p // MODULUS * len(COVER) + _SLOT[p % MODULUS]] for p in (i, j))
        a, b = np.minimum(a, b), np.maximum(a, b)
        more = np.zeros(len(a), dtype=np.int64)
        power = np.frexp((b - a).astype(np.float64))[1] - 1
        for k in np.unique(power).tolist():
            here = power == k
            more[here] = np.minimum(self.least[k][a[here]], self.least[k][b[here] - (1 << k)])
        out[far] += more
        return out


def _grids(starts: np.ndarray, sizes: np.ndarray, least: int, times: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(position, period) pairs, a bounded number at once, so that every run has one of its period in it.

    A run of period q is a stretch of at least max(least, times * q) - q positions with an equal word q further on, so
    every so many positions of a text are enough: the places for all periods are a harmonic sum.
    """
    most = sizes // times
    first = np.repeat(starts, most)
    size = np.repeat(sizes, most)
    period = np.arange(len(first)) - np.repeat(np.cumsum(most) - most, most) + 1
    step = np.maximum(least, times * period) - period
    count = np.maximum(0, -(-(size - period) // step))
    upto = np.cumsum(count)
    at, given = 0, 0
    while at < len(count):
        # A chunk has whole periods of a text; one alone has fewer places than the text has words.
        end = max(at + 1, int(np.searchsorted(upto, given + PLACES, side="right")))
        n = count[at:end]
        number = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        yield np.repeat(first[at:end], n) + number * np.repeat(step[at:end], n), np.repeat(period[at:end], n)
        given, at = int(upto[end - 1]), end


def runs(texts: list[list[bytes]], least: int = LEAST, times: int = TIMES) -> list[np.ndarray]:
    """For each list of words its runs as rows (start, length, period), by start and then period.

    A run is a stretch with smallest period q, of ``least`` words and ``times`` periods at least, that no neighbouring
    word extends.
    """
    coded, top = [], 0
    for words in texts:
        own: dict[bytes, int] = {}
        found = np.fromiter((own.setdefault(w, len(own)) for w in words), dtype=np.int64, count=len(words))
        # Numbers of their own, and one at the end that occurs once, keep texts apart.
        coded.append(np.r_[found + top, top + len(own)])
        top += len(own) + 1
    sizes = np.array([len(w) for w in texts], dtype=np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    ids = np.concatenate(coded) if coded else np.zeros(0, dtype=np.int64)
    places = [(k[same], q[same]) for k, q in _grids(starts, sizes, least, times) for same in [ids[k] == ids[k + q]]]
    k = np.concatenate([p[0] for p in places] or [np.zeros(0, np.int64)])
    q = np.concatenate([p[1] for p in places] or [np.zeros(0, np.int64)])
    if len(k):
        back = Extensions(ids[::-1].copy())
        last = len(ids) - 1
        before = back(last - (k - 1), last - (k + q - 1))
        del back
        low, high = k - before, k + q + Extensions(ids)(k, k + q)
        long = high - low >= np.maximum(least, times * q)
        low, high, q = low[long], high[long], q[long]
        # A stretch is found for multiples of its period too, and once for each of its places.
        by = np.lexsort((q, high, low))
        low, high, q = low[by], high[by], q[by]
        new = np.r_[True, (low[1:] != low[:-1]) | (high[1:] != high[:-1])][: len(low)]
        low, high, q = low[new], high[new], q[new]
        by = np.lexsort((q, low))
        low, high, q = low[by], high[by], q[by]
    else:
        low = high = q = np.zeros(0, dtype=np.int64)
    rows = np.stack([low, high - low, q], axis=1)
    cuts = np.searchsorted(low, starts)
    out = np.split(rows, cuts[1:]) if len(texts) else []
    return [r - np.array([s, 0, 0]) for r, s in zip(out, starts.tolist())]


def collapsed(words: list[bytes], found: np.ndarray) -> list[bytes]:
    """The words that stay when of each run only the first period does."""
    if not len(found):
        return words
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, found[:, 0] + found[:, 2], 1)
    np.add.at(edge, found[:, 0] + found[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]


RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])


def with_runs(
    docs: DataFrame, least: int = LEAST, times: int = TIMES, text: str = "text", found: str = "runs", rest: str = "collapsed"
) -> DataFrame:
    """Each row of ``docs`` without its text, with ``runs`` (start, length and period in words, by start and period) and
    ``collapsed``: the words outside runs and in the first period of each, joined by one space.

    Whole texts are searched, as many together as have some 100,000 words, or one that has more; a text's memory grows
    with its words. Null, empty and blank texts have no runs and collapse to the empty text; rows that repeat get equal
    values; an empty table gives an empty result. Columns named like the two new ones are replaced.
    """
    (source,) = fresh(docs, "_text_")
    kept = [F.col(f"`{c}`") for c in docs.columns if c != text and c.lower() not in (found.lower(), rest.lower())]
    rows = docs.select(*kept, F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias(source))
    schema = rows.drop(source).schema.add(found, T.ArrayType(RUN)).add(rest, T.StringType())
    arrow = pa.struct([(n, pa.int64()) for n in RUN.names])

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            held, first, count = [], 0, 0
            for i, value in enumerate(whole.column(whole.num_columns - 1)):
                # Bytes split at space and U+0009 to U+000D only.
                held.append(value.as_py().split())
                count += len(held[-1])
                if count >= WORDS or len(held) == ROWS or i == whole.num_rows - 1:
                    lists = runs(held, least, times)
                    flat = np.concatenate(lists)
                    ends = pa.array(np.cumsum([0, *map(len, lists)]), pa.int32())
                    parts = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], fields=list(arrow))
                    texts = [b" ".join(collapsed(w, r)).decode("utf-8", "replace") for w, r in zip(held, lists)]
                    batch = whole.slice(first, len(held))
                    columns = [*batch.columns[:-1], pa.ListArray.from_arrays(ends, parts), pa.array(texts, pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])
                    held, first, count = [], i + 1, 0

    return rows.mapInArrow(searched, schema)


def repeated(doc_id: Column, text: Column) -> Column:
    """The texts of the query: in a tenth of all documents the words from one on are a repetition of the first few."""
    words = split_words(text)
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def again(ws: Column) -> Column:
        n = F.size(ws)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        return F.array_join(
            F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(ws, F.when(i < a, i).otherwise(a + (i - a) % p))), " "
        )

    # Words are split once, in an array of one element.
    changed = F.element_at(F.transform(F.filter(F.array(words), lambda ws: F.size(ws) > 0), again), 1)
    return F.when((h % 10 == 0) & text.rlike(r"[^\x20\x09-\x0D]"), changed).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document: its runs' number, the longest one, and digests of all runs and of the words left."""
    docs = table(spark, sf_dir, "documents").select("doc_id", repeated(F.col("doc_id"), F.col("text")).alias("text"))
    best = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[n].cast("string") for n in RUN.names]), F.lit("\n")))
    return with_runs(docs).withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.n").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.floor(1000 * F.col("best.n") / -F.col("best.p")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
