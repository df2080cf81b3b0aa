"""LM scoring with a weighted backoff automaton over the n-grams of the training documents.

Texts are cut into parts of bounded size. Each part sends its distinct words, and then its distinct n-grams, packed, to buckets
that add up the counts of all parts and send back those that are known. A part's texts are then read through the automaton of
the n-grams that they hold, which is all of the whole automaton that they can reach.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import arrow_words, coded, distinct_of, joined, materialise, table

#: Fold that is held out of the training, of so many.
FOLDS, HELD_OUT = 5, 1
#: The token that ends each text. No word holds it.
END = b"\n"
#: A-Z in lower case, byte for byte.
LOWER = bytes(range(256)).lower()
#: Words of the longest n-grams.
ORDER = 3
#: n-grams seen less often have no arc, and what an arc gives up for those that have none.
LEAST, DISCOUNT = 2, 0.5
#: Tokens of a part, longer texts are cut, and the training tokens for which there is one bucket of n-grams.
PART, BUCKET = 1 << 19, 1 << 21
#: Bits of a word's id; an n-gram is the id of its beginning and that of its last word in one number.
BITS = 31
MASK = (1 << BITS) - 1
ROWS = 500
ROOT = 0
#: Tokens of a text that are read one after the other; stretches of it are read side by side.
STRETCH = 128
#: Spreads n-grams that begin alike, or end alike, over all buckets.
MIX = 1_000_003
#: Kinds of rows that a part is made of, and rows of a bucket: what n-grams that begin alike add up to, and the number of its words.
TEXT, WORDS, PAIRS, TRIPLES, AFTER_WORDS, AFTER_PAIRS, SUMS, DISTINCT = range(8)
ROW = "part long, kind int, bucket long, n long, a binary, b binary, c binary"
FIELDS = [f.split()[0] for f in ROW.split(", ")]
RUN = "bucket long, part long, begins binary, ends binary, times binary"


def tokens(text: bytes | None) -> list[bytes]:
    """Words, A-Z in lower case, and the end. Bytes split at space and U+0009 to U+000D only."""
    return [*(text or b"").lower().split(), END]


def with_ends(words: pa.Array, lengths: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Words of texts that stand behind each other with the end of each text, and the numbers of tokens."""
    places = np.insert(np.arange(len(words)), np.cumsum(lengths), len(words))
    return pa.concat_arrays([words, pa.array([END], words.type)]).take(pa.array(places)), lengths + 1


def held_out(doc_id: Column) -> Column:
    """Null ids are no fold and so in the training."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


@functools.cache
def _press() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(1)


@functools.cache
def _unpress() -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor()


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers of 64 bits as compressed byte planes: small numbers take little room."""
    planes = np.ascontiguousarray(numbers, np.int64).view(np.uint8).reshape(-1, 8).T
    return _press().compress(planes.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(_unpress().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.int64).ravel()


def packed_sorted(keys: np.ndarray) -> bytes:
    return packed(np.diff(keys, prepend=0))


def unpacked_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data))


def packed_words(words: pa.Array | list[bytes]) -> bytes:
    """No word holds a space."""
    return _press().compress(joined(words) if isinstance(words, pa.Array) else b" ".join(words))


def unpacked_words(data: bytes) -> list[bytes]:
    return _unpress().decompress(data).split(b" ")


def found_in(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of ``wanted`` in the sorted ``keys``, minus one for those that aren't there."""
    if not len(keys):
        return np.full(len(wanted), -1)
    # Looked up in order, near places of the keys follow each other.
    order = np.argsort(wanted)
    wanted, out = wanted[order], np.empty(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    out[order] = np.where(keys[at] == wanted, at, -1)
    return out


def by_bucket(bucket: np.ndarray) -> list[np.ndarray]:
    """Places of equal numbers, in order."""
    order = np.argsort(bucket, kind="stable")
    return [at for at in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(at)]


def parts(rows: DataFrame, most: int = PART) -> DataFrame:
    """Cut (id, held_out, text) into parts: a row for each text, without a part, and a row for each part.

    A word's code is its place among the sorted words of its part, whose ``times`` count the training tokens. ``pieces`` are rows,
    lengths, leads, and whether held out, of the texts in ``codes``. A text longer than a part goes on in the next one, after a
    lead: its last tokens before, as context.
    """
    schema = T.StructType.fromDDL("row long, held_out boolean, part long, trained long, codes binary, pieces binary, words binary, times binary")
    schema = T.StructType([rows.schema["id"], *schema])
    types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), *[pa.binary()] * 4]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = row = TaskContext.get().partitionId() << 32
        held_words: list[pa.Array] = []
        pieces: list[tuple[int, int, int, bool]] = []
        size, kind = 0, None

        def rows_of(id_: pa.Array, found: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array(x, t) for x, t in zip(zip(*found), types)]
            return pa.RecordBatch.from_arrays([id_, *columns], names=schema.names)

        def whole_part() -> pa.RecordBatch:
            codes, words = coded(pa.concat_arrays(held_words))
            told = np.array(pieces, np.int64).T
            _, lengths, leads, held = told
            place = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            trained = (place >= np.repeat(leads, lengths)) & (np.repeat(held, lengths) == 0)
            times = np.bincount(codes[trained], minlength=len(words))
            found = (0, False, part, int(times.sum()), packed(codes), packed(told.ravel()), packed_words(words), packed(times))
            return rows_of(pa.nulls(1, kind), [found])

        for whole in batches:
            kind = whole.column(0).type
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                found = []
                words, lengths = with_ends(*arrow_words(batch.column(2), LOWER))
                starts = np.cumsum(lengths) - lengths
                for held, start, length in zip(batch.column(1).to_pylist(), starts.tolist(), lengths.tolist()):
                    row += 1
                    found.append((row, held, *[None] * 6))
                    for begin in range(0, length, most):
                        lead = min(ORDER - 1, begin)
                        here = min(begin + most, length) - (begin - lead)
                        if size and size + here > most:
                            yield whole_part()
                            part, size = part + 1, 0
                            for held_ones in (held_words, pieces):
                                held_ones.clear()
                        held_words.append(words.slice(start + begin - lead, here))
                        pieces.append((row, here, lead, held))
                        size += here
                yield rows_of(batch.column(0), found)
        if size:
            yield whole_part()

    return rows.select("id", "held_out", "text").mapInArrow(cut, schema)


def _row(part: int, kind: int, bucket: int = 0, n: int = 0, **blobs: bytes) -> dict:
    return {"part": part, "kind": kind, "bucket": bucket, "n": n} | {c: blobs.get(c, b"") for c in "abc"}


def _frame(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=FIELDS)


def word_runs(cut: DataFrame, buckets: int) -> DataFrame:
    """(bucket, part, codes, words, times): the words of each part by the bucket that adds them up."""

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                words, times = unpacked_words(r.words), unpacked(r.times)
                bucket = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets
                found = [
                    (int(bucket[at[0]]), r.part, packed_sorted(at), packed_words([words[i] for i in at.tolist()]), packed(times[at]))
                    for at in by_bucket(bucket)
                ]
                yield pd.DataFrame(found, columns=["bucket", "part", "codes", "words", "times"])

    whole = cut.where("part IS NOT NULL").select("part", "words", "times")
    return whole.mapInPandas(runs, "bucket long, part long, codes binary, words binary, times binary")


def known_words(runs: DataFrame, buckets: int) -> DataFrame:
    """Add up the runs of all parts. Rows for parts with the codes and counts of their words and the numbers of the known ones,
    and a row for each bucket with how many words it has. A word's id is its number in the bucket, times ``buckets``, and the bucket.

    A word that the training holds once, if at all, needs no place where its own part has counted it.
    """

    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        bucket = int(rows["bucket"].iloc[0])
        own_times = [unpacked(t) for t in rows["times"]]
        held = coded(pa.concat_arrays([pa.array(unpacked_words(words), pa.large_binary()) for words in rows["words"]]))[0]
        times = np.bincount(held, weights=np.concatenate(own_times)).astype(np.int64)
        held = np.split(held, np.cumsum([len(t) for t in own_times])[:-1])
        known = times >= LEAST
        number = np.cumsum(known) - 1
        out = [_row(0, DISTINCT, bucket, int((times > 0).sum()))]
        for part, codes, here, own in zip(rows["part"], rows["codes"], held, own_times):
            told = known[here] | ((own == 0) & (times[here] > 0))
            here = here[told]
            if len(here):
                codes, numbers = unpacked_sorted(codes)[told], number[here[known[here]]]
                out.append(_row(part, WORDS, bucket, a=packed_sorted(codes), b=packed(times[here]), c=packed_sorted(numbers)))
        return _frame(out)

    return runs.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(merged, ROW)


class Unit:
    """A part's rows of all kinds, unpacked: texts, ids and counts of its words, and its known n-grams."""

    def __init__(self, rows: pd.DataFrame, buckets: int):
        kinds = {kind: frame for kind, frame in rows.groupby("kind")}
        self.part = int(rows["part"].iloc[0])
        text = kinds[TEXT].iloc[0]
        self.codes, self.counts = unpacked(text["a"]), unpacked(text["c"]).copy()
        self.rows, self.lengths, self.leads, self.held = unpacked(text["b"]).reshape(4, -1)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.ids, self.sums, self.kinds = np.full_like(self.counts, -1), np.zeros_like(self.counts), np.zeros_like(self.counts)
        none = rows.iloc[:0]
        after = {r.bucket: r for r in kinds.get(AFTER_WORDS, none).itertuples()}
        for r in kinds.get(WORDS, none).itertuples():
            at = unpacked_sorted(r.a)
            self.counts[at] = unpacked(r.b)
            known = at[self.counts[at] >= LEAST]
            self.ids[known] = unpacked_sorted(r.c) * buckets + r.bucket
            if r.bucket in after:
                self.sums[known], self.kinds[known] = unpacked(after[r.bucket].a), unpacked(after[r.bucket].b)
        self.grams = [[np.zeros(0, np.int64)] * 5] * 2
        for i, kind in enumerate((PAIRS, TRIPLES)):
            if kind in kinds:
                self.grams = [*self.grams[:i], self._known(i + 2, kinds[kind], kinds.get(AFTER_PAIRS, none), buckets), *self.grams[i + 1 :]]
        if self.ids.max(initial=0) >> BITS or self.grams[0][2].max(initial=0) >> BITS:
            raise OverflowError("more known words or pairs than ids have bits")

    def _known(self, order: int, rows: pd.DataFrame, after: pd.DataFrame, buckets: int) -> list[np.ndarray]:
        """Keys, counts, ids, sums and numbers of the known n-grams, by key. Buckets tell them by their places in the part's run."""
        keys = self.keys(order)[0]
        keys = distinct_of(keys[keys >= 0])
        runs = dict(_runs(keys, buckets))
        counts, ids, sums, numbers = (np.zeros_like(keys) for _ in range(4))
        after = {r.bucket: r for r in after.itertuples()} if order == 2 else {}
        for r in rows.itertuples():
            at = runs[r.bucket][unpacked_sorted(r.a)]
            counts[at] = unpacked(r.b)
            if r.c:
                ids[at] = unpacked_sorted(r.c) * buckets + r.bucket
            if r.bucket in after:
                sums[at], numbers[at] = unpacked(after[r.bucket].a), unpacked(after[r.bucket].b)
        return [x[counts > 0] for x in (keys, counts, ids, sums, numbers)]

    def keys(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """The n-grams that end at each token from the second, or third, on; minus one where none can be known.

        With each whether it counts: n-grams are counted in the text's piece that holds their last word; those of a lead are
        only known.
        """
        ids, first = self.ids[self.codes], np.zeros(len(self.codes), bool)
        first[self.starts] = True
        place = np.arange(len(self.codes)) - np.repeat(self.starts, self.lengths)
        counted = (place >= np.repeat(self.leads, self.lengths)) & (np.repeat(self.held, self.lengths) == 0)
        pairs = np.where((ids[:-1] >= 0) & (ids[1:] >= 0) & ~first[1:], ids[:-1] << BITS | ids[1:], -1)
        if order == 2:
            return pairs, counted[1:]
        at = found_in(self.grams[0][0], pairs)
        begin = self.grams[0][2][at] if len(self.grams[0][2]) else at
        return np.where((at[:-1] >= 0) & (at[1:] >= 0), begin[:-1] << BITS | ids[2:], -1), counted[2:]


def _runs(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket with the places of its n-grams. A bucket and a beginning tell the remainder of the last word's id."""
    bucket = ((keys >> BITS) * MIX + (keys & MASK)) % buckets
    for at in by_bucket(bucket):
        yield int(bucket[at[0]]), at


def gram_runs(units: DataFrame, order: int, buckets: int, tasks: int) -> DataFrame:
    """(bucket, part, begins, ends, times): the distinct n-grams of each part, and how often its training texts hold them."""

    def runs(rows: pd.DataFrame) -> pd.DataFrame:
        unit = Unit(rows, buckets)
        keys, counted = unit.keys(order)
        real = keys >= 0
        keys, place = np.unique(keys[real], return_inverse=True)
        times = np.bincount(place, weights=counted[real], minlength=len(keys)).astype(np.int64)
        found = [
            (bucket, unit.part, packed_sorted(keys[at] >> BITS), packed((keys[at] & MASK) // buckets), packed(times[at]))
            for bucket, at in _runs(keys, buckets)
        ]
        return pd.DataFrame(found, columns=["bucket", "part", "begins", "ends", "times"])

    return units.repartition(tasks, "part").groupBy("part").applyInPandas(runs, RUN)


def known_grams(runs: DataFrame, order: int, buckets: int) -> DataFrame:
    """Add up the runs of all parts. Rows for parts with the places in their run, the counts and the numbers of the known n-grams,
    and rows with the numbers of beginnings, and the counts and numbers of the bucket's n-grams that begin so, by the beginnings' bucket."""
    kind = PAIRS if order == 2 else TRIPLES

    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        bucket = int(rows["bucket"].iloc[0])
        held = []
        for begins, ends in zip(rows["begins"], rows["ends"]):
            begins = unpacked_sorted(begins)
            held.append(begins << BITS | unpacked(ends) * buckets + (bucket - begins * MIX) % buckets)
        keys, place = np.unique(np.concatenate(held), return_inverse=True)
        times = np.bincount(place, weights=np.concatenate([unpacked(t) for t in rows["times"]])).astype(np.int64)
        known = times >= LEAST
        number = np.cumsum(known) - 1
        out, at = [], 0
        for part, own in zip(rows["part"], held):
            here = place[at : at + len(own)]
            told, at = np.flatnonzero(known[here]), at + len(own)
            if len(told):
                out.append(_row(part, kind, bucket, a=packed_sorted(told), b=packed(times[here[told]]), c=packed_sorted(number[here[told]]) if order < ORDER else b""))
        begin, first = np.unique(keys[known] >> BITS, return_index=True)
        if len(begin):
            sums, numbers = np.add.reduceat(times[known], first), np.diff(first, append=int(known.sum()))
            for at in by_bucket(begin % buckets):
                out.append(_row(0, SUMS, int(begin[at[0]] % buckets), a=packed_sorted(begin[at] // buckets), b=packed(sums[at]), c=packed(numbers[at])))
        return _frame(out)

    return runs.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(merged, ROW)


def after(rows: DataFrame, kind: int, longer: DataFrame, buckets: int) -> DataFrame:
    """For each of the parts' rows of a kind what the longer n-grams that begin with each of its ids add up to, and their number."""
    told = AFTER_WORDS if kind == WORDS else AFTER_PAIRS

    def fill(mine: pd.DataFrame, sums: pd.DataFrame) -> pd.DataFrame:
        none = [np.zeros(0, np.int64)]
        ids, place = np.unique(np.concatenate([unpacked_sorted(x) for x in sums["a"]] or none), return_inverse=True)
        s, k = (
            np.bincount(place, weights=np.concatenate([unpacked(x) for x in sums[c]] or none), minlength=len(ids)).astype(np.int64)
            for c in "bc"
        )
        # For those that aren't there.
        s, k = np.append(s, 0), np.append(k, 0)
        out = []
        for r in mine.itertuples():
            at = found_in(ids, unpacked_sorted(r.c))
            out.append(_row(r.part, told, r.bucket, a=packed(s[at]), b=packed(k[at])))
        return _frame(out)

    own = rows.where(F.col("kind") == kind).select("part", "bucket", "c").repartition(buckets, "bucket").groupBy("bucket")
    added = longer.where(F.col("kind") == SUMS).select("bucket", "a", "b", "c").repartition(buckets, "bucket").groupBy("bucket")
    return own.cogroup(added).applyInPandas(fill, ROW)


class Automaton:
    """States are contexts; an arc reads a token that follows often enough; others fail to the shorter context.

    Order two: P(w | v) = (c(v w) - D) / c(v) + rest(v) P(w) for arcs, rest(v) P(w) through the failure arc, where
    rest(v) is what the arcs of v leave of one. Order three is built on order two in the same way, so the
    probabilities of all tokens, one of them standing for all unknown ones, add up to one in each state.

    Tokens are codes of a part's words. ``pairs`` and ``triples`` are (keys, counts, ids, sums, numbers), by key.
    """

    def __init__(self, unit: Unit, total: int, distinct: int):
        (pairs, c2, ids2, s2, k2), (triples, c3, *_) = unit.grams
        self.base = np.log10((unit.counts + 0.5) / (total + 0.5 * (distinct + 1)))
        self.width = n = len(unit.ids)
        one = 10.0**self.base
        rest1 = self._rest(unit.counts, unit.sums, unit.kinds)
        rest2 = self._rest(c2, s2, k2)
        # Words are states 1 to n if something follows them; pairs likewise come behind.
        start = np.where(unit.kinds > 0, np.arange(1, n + 1), ROOT)
        by_id = np.argsort(unit.ids, kind="stable")
        code = lambda ids: by_id[found_in(unit.ids[by_id], ids)]
        a, b = code(pairs >> BITS), code(pairs & MASK)
        second = (c2 - DISCOUNT) / unit.counts[a] + rest1[a] * one[b]
        wide = np.where(k2 > 0, np.arange(n + 1, n + 1 + len(pairs)), ROOT)
        to2 = np.where(wide > 0, wide, start[b])
        by_gram = np.argsort(ids2, kind="stable")
        high = by_gram[found_in(ids2[by_gram], triples >> BITS)]
        x = code(triples & MASK)
        low = found_in(pairs, unit.ids[b[high]] << BITS | unit.ids[x])
        third = (c3 - DISCOUNT) / c2[high] + rest2[high] * second[low]
        keys = np.concatenate([(a + 1) * n + b, (high + n + 1) * n + x])
        by_key = np.argsort(keys)
        self.keys = keys[by_key]
        self.to = np.concatenate([to2, to2[low]])[by_key]
        self.weight = np.log10(np.concatenate([second, third]))[by_key]
        self.back = np.log10(np.concatenate([[1.0], rest1, rest2]))
        self.fail = np.concatenate([np.zeros(n + 1, np.int64), start[b]])
        self.start = start

    @staticmethod
    def _rest(counts: np.ndarray, sums: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        return np.maximum(1 - (sums - DISCOUNT * kinds) / np.maximum(counts, 1), 1e-12)

    def step(self, state: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Read a code in each state: what it weighs, failure arcs included, and the states that follow."""
        weights, after_, state, left = np.zeros(len(codes)), self.start[codes], state.copy(), np.arange(len(codes))
        while len(left):
            root = state[left] == ROOT
            weights[left[root]] += self.base[codes[left[root]]]
            left = left[~root]
            arc = found_in(self.keys, state[left] * self.width + codes[left])
            hit = arc >= 0
            weights[left[hit]] += self.weight[arc[hit]]
            after_[left[hit]] = self.to[arc[hit]]
            left = left[~hit]
            weights[left] += self.back[state[left]]
            state[left] = self.fail[state[left]]
        return weights, after_

    def weights(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """What each code weighs in texts that are read from left to right.

        A state knows ORDER - 1 tokens at most, so a text is read in stretches, each after so many tokens that lead to its state.
        """
        number = -(-lengths // STRETCH)
        low, high = np.repeat(starts, number), np.repeat(starts + lengths, number)
        begin = low + STRETCH * (np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number))
        state, out = np.full(len(begin), ROOT), np.zeros(len(codes))
        for at in range(1 - ORDER, STRETCH):
            live = np.flatnonzero((begin + at >= low) & (begin + at < high))
            here = begin[live] + at
            found, state[live] = self.step(state[live], codes[here])
            if at >= 0:
                out[here] = found
        return out

    def score(self, codes: list[int], lead: int = 0) -> float:
        """What a text weighs; its first ``lead`` codes only lead to a state."""
        return float(self.weights(np.array(codes), np.array([0]), np.array([len(codes)]))[lead:].sum())


def part_scores(units: DataFrame, total: int, distinct: int, buckets: int, tasks: int) -> DataFrame:
    """(row, n_tokens, n_known, base_score, score) of each text, or piece of one, of each part."""

    def scored(rows: pd.DataFrame) -> pd.DataFrame:
        unit = Unit(rows, buckets)
        automaton = Automaton(unit, total, distinct)
        weights, known, out = automaton.weights(unit.codes, unit.starts, unit.lengths), unit.counts > 0, []
        for row, lead, start, length in zip(*(x.tolist() for x in (unit.rows, unit.leads, unit.starts, unit.lengths))):
            own = unit.codes[start + lead : start + length]
            score = float(weights[start + lead : start + length].sum())
            out.append((row, len(own), int(known[own].sum()), float(automaton.base[own].sum()), score))
        return pd.DataFrame(out, columns=["row", "n_tokens", "n_known", "base_score", "score"])

    return units.repartition(tasks, "part").groupBy("part").applyInPandas(scored, "row long, n_tokens long, n_known long, base_score double, score double")


def scored(
    docs: DataFrame, order: int = ORDER, doc_id: str = "doc_id", text: str = "text", part: int = PART, bucket: int = BUCKET
) -> DataFrame:
    """One row for each row of ``docs``: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Counts are of all tokens of all training rows, and so are the n-grams of up to ``order`` words (3 at most) that are seen
    LEAST times, whatever the table's size; ``part`` and ``bucket`` change no result. Words are told apart by their bytes and n-grams by the ids of their words. Ids
    leave room for 2 ** 31 words seen LEAST times and as many pairs; more are an error.

    Null and empty texts are an end only. Rows with a null id are training rows; rows that repeat are counted and
    scored each. With no training row every token has the probability of an unknown one. An empty table gives no row.
    Other columns aren't read, whatever their names.
    """
    rows = docs.select(F.col(doc_id).alias("id"), held_out(F.col(doc_id)).alias("held_out"), F.col(text).cast("binary").alias("text"))
    cut = materialise(parts(rows, part), "lm-parts")
    whole = cut.where("part IS NOT NULL")
    tasks, total = whole.agg(F.count("*"), F.coalesce(F.sum("trained"), F.lit(0))).first()
    tasks, buckets = max(1, tasks), int(1 + total // bucket)
    words = materialise(known_words(word_runs(cut, buckets), buckets), "lm-words")
    distinct = words.where(F.col("kind") == DISTINCT).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    zero = F.lit(0).cast("long")
    texts = whole.select(
        "part", F.lit(TEXT).alias("kind"), zero.alias("bucket"), zero.alias("n"), F.col("codes").alias("a"), F.col("pieces").alias("b"), F.col("times").alias("c")
    )
    units, shorter = texts.unionByName(words.where(F.col("kind") == WORDS)), words
    follow = []
    for n in range(2, order + 1):
        kind = PAIRS if n == 2 else TRIPLES
        grams = materialise(known_grams(gram_runs(units, n, buckets, tasks), n, buckets), f"lm-grams-{n}")
        units = units.unionByName(grams.where(F.col("kind") == kind))
        follow.append(after(shorter, kind - 1, grams, buckets))
        shorter = grams
    for rows in follow:
        units = units.unionByName(rows)

    pieces = part_scores(units, total, distinct, buckets, tasks)
    sums = pieces.groupBy("row").agg(*[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
    first = cut.where("part IS NULL").select("row", "id", "held_out")
    return first.join(sums, "row").select(
        "id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score"
    )


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scored(docs).withColumnRenamed("id", "doc_id")
