"""Words and n-grams travel packed, and texts are read side by side."""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from tidemark.llm import common, divergence, lm
from tidemark.llm.divergence import Transducer


def test_stretches_weigh_what_the_whole_text_weighs():
    ids, shift, none = np.array([0, 1, 2, 3, -1]), lm.BITS, np.zeros(0, np.int64)
    pairs = [np.array([0, 1, 1 << shift | 2]), np.array([2, 3, 2]), np.array([7, 5, 9]), np.array([0, 2, 0]), np.array([0, 1, 0])]
    triples = [np.array([5 << shift | 2]), np.array([2]), np.array([0]), none, none]
    unit = SimpleNamespace(ids=ids, counts=np.array([6, 4, 3, 2, 0]), sums=np.array([5, 2, 0, 0, 0]), kinds=np.array([2, 1, 0, 0, 0]), grams=[pairs, triples])
    automaton, codes = lm.Automaton(unit, 15, 4), np.random.default_rng(1).integers(0, 5, 5 * lm.STRETCH + 7)
    lengths = np.array([3 * lm.STRETCH, 1, 2 * lm.STRETCH + 6])
    starts, each = np.cumsum(lengths) - lengths, []
    for start, length in zip(starts, lengths):
        state = np.array([lm.ROOT])
        for code in codes[start : start + length]:
            weight, state = automaton.step(state, np.array([code]))
            each.append(weight[0])
    assert automaton.weights(codes, starts, lengths) == pytest.approx(each)


def test_a_part_sends_a_row_to_a_bucket_not_one_for_each_word(spark):
    docs = spark.createDataFrame([(i, i % 5 == 1, f"a b w{i} x{i}".encode()) for i in range(400)], "id long, held_out boolean, text binary").coalesce(2)
    cut = lm.parts(docs)
    runs = lm.word_runs(cut, 3)
    assert runs.count() <= 2 * 3
    words = lm.known_words(runs, 3).cache()
    assert words.agg(F.sum("n")).first()[0] == 3 + 2 * sum(i % 5 != 1 for i in range(400))
    # a, b and the end are known, each in both parts.
    told = [len(lm.unpacked_sorted(r["c"])) for r in words.where(F.col("kind") == lm.WORDS).collect()]
    assert sum(told) == 3 * 2


def test_transducer_of_terms_that_begin_alike():
    terms = sorted([b"a", b"ab", b"abc", b"abd", b"b", b"bc", "é".encode(), "éa".encode()])
    machine = Transducer(terms)
    assert machine.ordinals(b" ".join(terms)).tolist() and sorted(machine.ordinals(b" ".join(terms))) == list(range(len(terms)))


def test_words_in_arrow_are_the_words_of_each_text():
    texts = pa.array([b"\xff\x85 A\x1c\x1db\x0b\x0cC  \x00 ", b"", None, b" \n ", b"A b", "é Éx".encode()] * 3, pa.binary())
    for some in (texts, texts.slice(3, 7), texts.slice(2, 0), texts.slice(2, 2)):
        words, lengths = lm.with_ends(*common.arrow_words(some, lm.LOWER))
        want = [lm.tokens(text) for text in some.to_pylist()]
        assert words.to_pylist() == [w for text in want for w in text] and lengths.tolist() == [len(text) for text in want]
    codes, words = common.coded(pa.array([b"b", b"a", b"b", b"\xff", b"\n"], pa.large_binary()))
    assert codes.tolist() == [2, 1, 2, 3, 0] and lm.unpacked_words(lm.packed_words(words)) == [b"\n", b"a", b"b", b"\xff"]


def test_different_keys_of_a_part_are_found_by_sorting(monkeypatch):
    monkeypatch.setattr(np, "unique", None)
    assert common.distinct_of(np.array([3, 1, 3, 0, -2])).tolist() == [-2, 0, 1, 3]
    assert common.distinct_of(np.zeros(0, np.int64)).tolist() == []


def test_a_word_that_occurs_often_is_read_once(monkeypatch):
    read = []
    was = Transducer.read
    monkeypatch.setattr(Transducer, "read", lambda self, words: read.append(len(words)) or was(self, words))
    packets = [zstandard.compress(x) for x in (b"a b a a", b"a zz a", b"b")]
    packets = pa.table({"part": [0] * 3, "lang": ["l"] * 3, "source": ["s", "s", "t"], "packet": packets})
    terms = pa.table({"at": [0] * 2, "of": ["l"] * 2, "term": [b"b", b"a"], "ordinal": [8, 7]})
    told = divergence._recounted(packets, terms).to_pylist()
    assert read == [2, 2, 1]
    assert sorted((r["source"], r["ordinal"], r["n"]) for r in told) == [("s", 7, 5), ("s", 8, 1), ("t", 8, 1)]


def test_documents_are_counted_once_for_each_of_their_terms(spark):
    rows = [("a b a", "l", "s"), ("B c", "l", "t"), (None, "l", "t"), ("b", "m", "s")] * 2
    cut = divergence.parts(spark.createDataFrame(rows, "text string, lang string, source string").coalesce(1), "lang", "source", "text")
    told = cut.where("terms IS NOT NULL").select("lang", F.explode(F.arrays_zip("terms", "docs")).alias("t"))
    told = {(r["lang"], bytes(r["t"]["terms"]), r["t"]["docs"]) for r in told.collect()}
    assert told == {("l", b"a", 2), ("l", b"b", 4), ("l", b"c", 2), ("m", b"b", 2)}


def test_shares_of_counts_beyond_64_bits(spark):
    rows = [(n, 2 * n + 5) for n in (0, 7, (1 << 63) // 10**9 - 2, (1 << 63) // 10**9 - 1, 10**14)]
    df = spark.createDataFrame(rows, "n long, total long").select("n", "total", divergence.share("n", "total", "3").alias("p"))
    assert [r["p"] for r in df.collect()] == [1 + 10**9 * (n + 1) // (total + 3) for n, total in rows]
