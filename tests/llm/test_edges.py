"""Nulls in any column, empty and very long texts, repeated rows, empty tables, clashing column names."""

import random
import re

import pytest

import corpus_pipeline
from tidemark.llm import common, covertree, divergence, licences, lines, lm, mixing, periodic, pieces, pii, quality, sharding, simhash, urls

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977}" for i in range(60_000))
ROWS = [
    (1, "the cat of the house and the dog", "en", "a", 32),
    (1, "the cat of the house and the dog", "en", "a", 32),
    (2, None, None, None, None),
    (2, None, None, None, None),
    (None, "", "en", "a", 0),
    (None, None, None, "b", None),
    (3, " \t\n ", "en", None, 4),
    (4, LONG, "en", "b", len(LONG)),
    (5, "a\nb\nb\n\nc", "en", "c", 8),
    (5, "other text under one id", "en", "c", 23),
]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def every(docs):
    """(name, result, whether it has a row for each row)."""
    yield "quality", quality.judged(docs), True
    yield "good", quality.keep_good(docs), False
    yield "lines", lines.without_boilerplate(docs, min_sites=2), True
    yield "classes", simhash.classes(docs), True
    yield "one", simhash.one_of_each(docs), False
    yield "mixed", mixed(docs), True
    yield "drawn", mixing.drawn(docs), False
    yield "pieces", pieces.encoded(docs, pieces.load(), decoded="decoded"), True
    yield "shards", sharding.sharded(docs, shards=4), True
    yield "urls", urls.judged(docs.withColumnRenamed("text", "url")), True
    yield "licences", licences.scanned(docs, licences.build()), True
    yield "lm", lm.scored(docs), True
    yield "runs", periodic.with_runs(docs), True
    yield "personal", pii.with_spans(docs), True
    yield "redacted", pii.redacted(docs), True
    yield "divergence", divergence.audited(docs), False


def mixed(docs):
    return mixing.mixed(docs)


def test_every_operator_takes_such_rows(docs):
    for name, out, whole in every(docs):
        rows = out.collect()
        assert len(rows) == len(ROWS) if whole else len(rows) <= 1000 if name == "divergence" else len(rows) <= 3 * len(ROWS), name


def test_every_operator_takes_an_empty_table(none):
    for name, out, _ in every(none):
        assert out.collect() == [], name


def test_every_stage_takes_such_rows_and_none(spark, docs, none):
    for rows in (docs, none):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, "")
            out.collect()


def test_clashing_columns(docs):
    clash = docs.selectExpr("*", "1 AS kept", "2 AS _words", "3 AS ids", "4 AS n_removed", "5 AS id", "6 AS row", "7 AS _id", "8 AS key", "9 AS size", "'x' AS score", "10 AS before", "11 AS labels", "12 AS runs", "13 AS collapsed", "14 AS _text_", "15 AS pii", "16 AS _found_", "17 AS _s")
    for name, out, whole in every(clash):
        columns = [c.lower() for c in out.columns]
        assert len(columns) == len(set(columns)), name
        assert (out.count() == len(ROWS)) or not whole, name
    assert simhash.one_of_each(clash).columns == mixing.drawn(clash).columns == quality.keep_good(clash).columns == clash.columns


def test_quality_values(spark):
    text = "a b c d e f g h a b c d e f g h"
    row = quality.judged(spark.createDataFrame([(text,)], "text string")).first()
    assert (row["n_words"], row["n_repeat_words"], row["base_failed"], row["kept"]) == (16, 16, True, False)
    overlap = "x x x x x x x x x x y"
    assert quality.measured(spark.createDataFrame([(overlap,)], "text string")).first()["n_repeat_words"] == 10


def test_boilerplate_stays_once(spark):
    rows = [(i, f"menu of all sites\nown line {i}\n\nmenu of all sites", f"s{i}") for i in range(6)] + [(9, "menu of all sites", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r["doc_id"]: (r["text"], r["n_removed"]) for r in lines.without_boilerplate(df, min_sites=7).collect()}
    assert out[0] == ("menu of all sites\nown line 0\n", 1) and out[3] == ("own line 3\n", 2) and out[9] == ("", 1)
    assert all(r["n_removed"] == 0 for r in lines.without_boilerplate(df, min_sites=8).collect())
    bare = {r["doc_id"]: r["text"] for r in lines.without_boilerplate(df, min_sites=7, keep_first=False).collect()}
    assert bare[0] == "own line 0\n"


def test_sketches_decide_as_exact_counts(spark):
    rows = [(i, f"line {n}", f"s{i}") for n in (150, 190, 200, 210, 400) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    places = common.materialise(lines.line_places(df, "doc_id", "text", "source"), "places")
    assert lines.boilerplate(places, 200).count() == 3


def test_buckets_are_cut_without_loss(spark):
    rnd = random.Random(3)
    seeds = [rnd.getrandbits(63) for _ in range(4)]
    fps = {s ^ (1 << rnd.randrange(60)) ^ (1 << rnd.randrange(60)) for s in seeds for _ in range(120)}
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    near = lambda a, b: (a ^ b).bit_count() <= 4
    for piece in (7, 8192):
        roots = {r["node"]: r["root"] for r in common.components(simhash.links(df, piece=piece), "t").collect()}
        fps_ = sorted(fps)
        # Two rows are in one component exactly if a chain of close ones joins them.
        todo, group = set(fps_), {}
        while todo:
            first = todo.pop()
            front, seen = [first], {first}
            while front:
                x = front.pop()
                more = {y for y in todo if near(x, y)}
                todo -= more
                seen |= more
                front += more
            group |= {y: min(seen) for y in seen}
        label = {}
        for f in fps_:
            label.setdefault(roots.get(f, f), set()).add(group[f])
        assert all(len(x) == 1 for x in label.values()) and len(label) == len(set(group.values()))


def test_near_dedup_stage_keeps_one_of_each_group_of_fingerprints(spark):
    rnd = random.Random(7)
    texts = []
    for _ in range(12):
        base = [f"w{rnd.randrange(5000)}" for _ in range(600)]
        texts.append(" ".join(base))
        for changes in (0, 1, 1, 2, 40):
            copy = list(base)
            for at in rnd.sample(range(len(copy)), changes):
                copy[at] = f"x{rnd.randrange(5000)}"
            texts.append(" ".join(copy))
    prints = [simhash.fingerprint(t.encode().split(), 4) & (1 << 64) - 1 for t in texts]
    near = [(i, j) for i in range(len(texts)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    root = list(range(len(texts)))
    for _ in texts:
        for i, j in near:
            root[i] = root[j] = min(root[i], root[j])
    df = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in enumerate(texts)], SCHEMA)
    got = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, df, "").collect()}
    assert got == {i for i in range(len(texts)) if root[i] == i} and 12 <= len(got) < len(texts) - 12


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, i) for i in range(1001, 1200)] + [(5, 5)]
    out = common.components(spark.createDataFrame(chain + star, "a long, b long"), "t").collect()
    assert len(out) == 201 + 200 and len({r["root"] for r in out if r["node"] <= 200}) == len({r["root"] for r in out if r["node"] >= 1000}) == 1


def test_odd_vectors(spark):
    big = [1e308, 1e308]
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, []), (6, [1.0, None]), (7, [float("nan"), 1.0]), (8, [float("inf"), 0.0]),
            (9, [1.0, 0.0]), (None, [1.0, 0.01]), (10, [1.0, 0.0, 0.0]), (11, big), (12, [1e-300, 1e-300]), (12, [1e-300, 1e-300])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = {(r["id"], r["n_links"], r["component_id"]) for r in covertree.near_duplicates(df).collect()}
    assert out == {(1, 3, 1), (2, 3, 1), (9, 3, 1), (None, 3, 1), (10, 0, 10), (11, 2, 11), (12, 2, 11), *((i, 0, i) for i in range(3, 9))}
    assert covertree.near_duplicates(df.where("vec_id = 0")).collect() == []


@pytest.mark.parametrize("block", [40, 1000])
def test_vectors_in_blocks(spark, monkeypatch, block):
    import numpy as np

    monkeypatch.setattr(covertree, "BLOCK", block)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(150, 6))
    x[75:] = x[rng.integers(0, 75, 75)] + rng.normal(size=(75, 6)) * 0.15
    x[100:140] = x[100] + rng.normal(size=(40, 6)) * 0.01
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (u @ u.T >= 0.9).sum(axis=1) - 1
    assert {r["id"]: r["n_links"] for r in covertree.near_duplicates(df).collect()} == dict(enumerate(near.tolist()))


def test_targets_stop_at_three_times_the_size():
    assert mixing.targets([10, 1000, 0, 1000], [5, 2, 1, 5], 2010) == [30.0, 1980 * 2 / 7, 0.0, 1980 * 5 / 7]
    assert mixing.targets([], [], 0) == [] and mixing.targets([0], [5], 0) == [0.0]


def test_sainte_lague_is_the_highest_quotients():
    rnd = random.Random(1)
    for _ in range(60):
        n = rnd.randint(1, 7)
        weights, most = [rnd.choice([0, 1, 2, 5, 5, 13, 40.5]) for _ in range(n)], [rnd.randint(0, 40) for _ in range(n)]
        seats, given = rnd.randint(0, 60), [0] * n
        for _ in range(seats):
            open_ = [i for i in range(n) if given[i] < most[i] and weights[i]]
            if open_:
                given[max(open_, key=lambda i: (weights[i] / (2 * given[i] + 1), -i))] += 1
        assert mixing.sainte_lague(weights, seats, most) == given


def test_drawn_text_is_what_was_taken(spark):
    rows = [(i, " ".join(f"d{i}w{k}" for k in range(20 + i)), "a" if i % 3 else "b") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = {r["id"]: r["taken"] for r in mixing.mixed(df).collect()}
    words = {}
    for r in mixing.drawn(df).collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(r["text"].split())
        assert r["text"] in rows[r["doc_id"]][1]
    assert words == {i: n for i, n in taken.items() if n}


def test_drawn_joins_equal_rows_one_to_one(spark):
    rows = [(None, "one two three four five six", "a")] * 40 + [(1, "seven eight nine ten", "b")]
    out = mixing.drawn(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Join Inner, .*_n#\d+ = _n#\d+", plan)
    taken = sum(r["taken"] for r in mixing.mixed(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect())
    assert sum(len(r["text"].split()) for r in out.collect()) == taken


def test_one_more_shard_moves_keys_to_it_only_where_loads_allow():
    before, after = sharding.ring(16), sharding.ring(17)
    assert [n for n in after if n[1] < 16] == before
    flow = sharding.flow([0, 1, 0], {0: [(0, 10)], 1: [(10, 20)], 2: [(20, 50)]}, 2, 26)
    load = [sum(b - a for a, b, s in flow if s == k) for k in (0, 1)]
    assert sum(load) == 50 and max(load) <= 26 and sorted(a for a, _, _ in flow)[0] == 0


def test_pieces_of_odd_texts():
    import sentencepiece

    model, library = pieces.load(), sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    rnd = random.Random(2)
    texts = ["", " ", "  ", "   x", "a  b   c    d", " " * 15 + "x" + " " * 40, "▁a▁▁b", "日本語。漢字", "\x00a\x01", "   .", "\n\n  x", "<s> </s><0x0A>", LONG[:5000]]
    texts += ["".join(rnd.choice("abcdefgh  .,ABCéß\n😀") for _ in range(rnd.randint(1, 60))) for _ in range(500)]
    for text in texts:
        ids = model.ids(text)
        assert ids.tolist() == library.encode(text) and model.text(ids) == text.replace(pieces.MARK, " ")


def test_licence_notice_with_gaps():
    automaton = licences.build()
    notice = dict((label, text) for label, text in licences.NOTICES)["bsd"].encode()
    words = notice.split()
    broken = b" ".join(words[:9] + [b"zzz"] + words[9:])
    assert licences.judge(automaton, broken)[5] == "bsd"
    assert licences.judge(automaton, b" ".join(words[:6]))[5] == ""
    spread = b" ".join(words[:9] + [b"zzz"] * 50 + words[9:])
    assert licences.judge(automaton, spread)[5] == ""
