"""Registered queries against brute force or their SQL, over whole tables."""

import math
import re
import zlib
from collections import Counter
from types import SimpleNamespace

import duckdb
import numpy as np
import pytest
import sentencepiece
import xxhash

import __spark_entry__ as contract
import corpus_pipeline
from compare import connect, mismatch

from pyspark.sql import functions as F

from tidemark.llm import common, licences, lm, mixing, pieces, quality, simhash, urls

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(columns="doc_id, text, source"):
    return duckdb.sql(f"SELECT {columns} FROM '{SMALL}/documents.parquet' ORDER BY doc_id").fetchall()


def result(spark, name):
    rows = contract.queries()[name](spark, SMALL).collect()
    return {r[0]: r for r in rows} if len({r[0] for r in rows}) == len(rows) else rows


def roots(ids, pairs):
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("name", ["op4_line_dedup", "op9_quality_rules", "op10_source_mixing"])
def test_query_agrees_with_sql(spark, name):
    assert mismatch(spark, connect(SMALL), SMALL, name) is None


def test_embeddings(spark):
    found = result(spark, "op1_embedding_near_dedup")
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SMALL}/embeddings.parquet' ORDER BY vec_id").fetchall()
    ids, x = [r[0] for r in rows], np.array([r[1] for r in rows], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    want = roots(ids, [(ids[i], ids[j]) for i, j in zip(*np.nonzero(near))])
    assert set(found) == set(ids)
    for i, n in zip(ids, near.sum(axis=1)):
        assert tuple(found[i]) == (i, n, want[i], want[i] == i)


def test_simhash(spark):
    found, prints = result(spark, "op3_simhash_near_dedup"), {}
    for i, text, _ in documents():
        words = [w.encode().lower() for w in WORD.findall(text)]
        grams = [b" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    ids = sorted(prints)
    pairs = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    want = roots(ids, pairs)
    assert pairs and {i: (r[1], r[2]) for i, r in found.items()} == {i: (f"{prints[i]:016x}", want[i]) for i in ids}


def test_sharding(spark):
    found = result(spark, "op5_sharding")
    docs = documents("doc_id, text")
    assert set(found) == {i for i, _ in docs}
    sizes, slots = Counter(), {}
    for i, text in docs:
        row, raw = found[i], text.encode()
        assert (row["size"], row["text_crc32"], row["law"], row["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        sizes[row["shard"]] += row["size"]
        slots.setdefault(row["shard"], []).append(row["slot"])
    assert set(sizes) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    # Rows that cross a border are all that parts the shards.
    assert max(sizes.values()) <= sum(sizes.values()) * 1.001 / 16 + max(r["size"] for r in found.values())


def test_urls(spark):
    found = result(spark, "op6_url_filter")
    rows = duckdb.sql(f"SELECT page_id, url FROM '{SMALL}/pages.parquet'").fetchall()
    assert set(found) == {i for i, _ in rows}
    rules = [("net", "/", "net/", "block"), ("example.net", "/en/", "example.net/en/", "allow"), ("example.com", "/de/", "example.com/de/", "block"), ("org", "/fr/", "org/fr/", "allow")]
    for i, url in rows:
        rest = url.split("://", 1)[1] if "://" in url else ""
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host) :])[0] if rest[len(host) :].startswith("/") else ""
        host = host.encode().lower().decode()
        fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
        best = max(fits, key=lambda r: len(r[2]), default=None)
        row = found[i]
        assert (row["host"], row["path"], row["rule"]) == (host, path, best and best[2])
        assert row["verdict"] == best[3] if best else row["verdict"] in ("allow", "block")


def test_urls_learn_rejected_hosts(spark):
    good = [f"https://{a}{b}.example.com/en/{n}" for a in ("river", "stone", "cloud", "field") for b in ("side", "works", "house") for n in range(12)]
    bad = [f"https://{a}-{b}.example.com/en/{n}" for a in ("casino", "bets", "pills") for b in ("win", "cash", "bonus", "royal") for n in range(6)]
    # None of the words that mark an example stands alone here.
    new = ["https://casinowinbets.example.com/en/1", "https://pillsbonus.example.com/en/2", "https://stoneside.example.com/en/3"]
    df = spark.createDataFrame(list(enumerate(good + bad + new)), "page_id long, url string")
    verdicts = {r["url"]: r["verdict"] for r in urls.judged(df).collect()}
    assert [verdicts[u] for u in new] == ["block", "block", "allow"]
    assert sum(verdicts[u] == "block" for u in good) == 0 and all(verdicts[u] == "block" for u in bad)


def test_urls_score_is_that_of_a_plain_model(spark):
    """The automaton-free version: counts in dictionaries, one recursive probability, no pruning."""
    texts = {"\nab.c/ab\n": (False, 3), "\nab.d/00\n": (False, 2), "\ncas.c/a\n": (True, 4), "\ncab.d/c\n": (True, 2)}
    df = spark.createDataFrame([(s, r, n) for s, (r, n) in texts.items()], "s string, rejected boolean, n long")
    got = {r["s"]: r["score"] for r in urls.scored(df, urls.model(df)).collect()}
    counts = {False: Counter(), True: Counter()}
    for s, (rejected, n) in texts.items():
        for i in range(1, len(s)):
            for k in range(1, min(i + 1, urls.CONTEXT + 1) + 1):
                counts[rejected][s[i + 1 - k : i + 1]] += n

    def chance(kind, ctx, c):
        table = counts[kind]
        total = sum(n for g, n in table.items() if len(g) == len(ctx) + 1 and g.startswith(ctx))
        low = chance(kind, ctx[1:], c) if ctx else 1 / urls.ALPHABET
        return (table[ctx + c] + urls.PRIOR * low) / (total + urls.PRIOR)

    for s in texts:
        parts = [math.log(chance(True, s[max(0, i - urls.CONTEXT) : i], s[i]) / chance(False, s[max(0, i - urls.CONTEXT) : i], s[i])) for i in range(1, len(s))]
        assert got[s] == pytest.approx(sum(parts) / len(parts))


def test_urls_model_keeps_rare_grams_of_large_tables(spark):
    """More distinct n-grams than 60,000, all seen more often than those of the rejected string."""
    good = spark.range(25_000).selectExpr("concat('\\n', substring(md5(cast(id AS string)), 1, 12), '\\n') AS s", "false AS rejected", "9L AS n")
    bad = spark.createDataFrame([("\nzqxw.zq/\n", True, 2)], "s string, rejected boolean, n long")
    found = urls.model(good.union(bad)).where("value IS NOT NULL")
    assert found.count() > 60_000
    assert {"zqxw.", "qxw.z", ".zq/\n"} <= {r["gram"] for r in found.where("gram LIKE '%z%' OR gram LIKE '%q%'").collect()}


def test_licences(spark):
    found = result(spark, "op7_licence_scan")
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    phrases = {tuple(word.findall(p)): label for p, label in licences.PHRASES.items()}
    for i, text, _ in documents():
        words = word.findall(text.encode().lower().decode())
        places = [(k, label) for p, label in phrases.items() for k in range(len(words)) if tuple(words[k : k + len(p)]) == p]
        row = found[i]
        assert (row["n_words"], row["n_base"]) == (len(words), len(places))
        starts = [k for k, _ in places]
        assert (row["first_word"], row["last_word"]) == (min(starts, default=None), max(starts, default=None))
        base = {label for _, label in places}
        assert row["base_labels"] == ",".join(sorted(base)) and base <= set(row["labels"].split(",")) | {""}
        assert ("gpl-3" in row["labels"]) == ("gnu general public license" in text.lower())
        assert 0 <= row["score"] <= 1 and (row["score"] > 0) >= bool(row["labels"])


def test_lm_base(spark):
    found = result(spark, "op8_lm_scoring")
    docs = {i: lm.tokens(text.encode()) for i, text, _ in documents()}
    out = {i for i in docs if zlib.crc32(str(i).encode()) % 5 == 1}
    counts = Counter(t for i, words in docs.items() if i not in out for t in words)
    n, v = sum(counts.values()), len(counts)
    for i, words in docs.items():
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in words)
        row = found[i]
        assert (row["held_out"], row["n_tokens"], row["n_known"], row["train_tokens"]) == (i in out, len(words), sum(t in counts for t in words), n)
        assert row["base_score"] == pytest.approx(base, rel=1e-9)
    # More likely than under single tokens on what is held out, too.
    assert sum(found[i]["score"] - found[i]["base_score"] for i in out) > 0


def test_lm_automaton_is_the_backoff_model(spark):
    docs = {i: lm.tokens(text.encode()) for i, text, _ in documents()}
    found = result(spark, "op8_lm_scoring")
    train = [w for i, w in docs.items() if zlib.crc32(str(i).encode()) % 5 != 1]
    c1 = Counter(t for w in train for t in w)
    c2 = {k: n for k, n in Counter(p for w in train for p in zip(w, w[1:])).items() if n >= lm.LEAST}
    c3 = {k: n for k, n in Counter(p for w in train for p in zip(w, w[1:], w[2:])).items() if n >= lm.LEAST}
    n, v, d = sum(c1.values()), len(c1), lm.DISCOUNT
    rest2, rest3 = Counter(), Counter()
    for (a, _), c in c2.items():
        rest2[a] += (c - d) / c1[a]
    for (a, b, _), c in c3.items():
        rest3[a, b] += (c - d) / c2[a, b]

    def chance(ctx, t):
        one = (c1[t] + 0.5) / (n + 0.5 * (v + 1))
        if not ctx:
            return one
        two = max(0, c2.get((ctx[-1], t), d) - d) / max(1, c1[ctx[-1]]) + (1 - rest2[ctx[-1]]) * one
        if len(ctx) == 1:
            return two
        return max(0, c3.get((*ctx, t), d) - d) / c2.get(ctx, 1) + (1 - rest3[ctx]) * two

    for i in list(docs)[:40]:
        w = docs[i]
        want = sum(math.log10(chance(tuple(w[max(0, k - 2) : k]), w[k])) for k in range(len(w)))
        assert found[i]["score"] == pytest.approx(want, rel=1e-6)


def test_lm_parts_and_buckets_change_no_score(spark):
    """Texts cut every 40 tokens, and n-grams spread over many buckets."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60).cache()
    want = {r["id"]: r for r in lm.scored(docs).collect()}
    found = {r["id"]: r for r in lm.scored(docs, part=40, bucket=500).collect()}
    assert set(found) == set(want) and any(abs(r["score"] - r["base_score"]) > 1 for r in want.values())
    for i, r in want.items():
        assert tuple(found[i])[:5] == tuple(r)[:5]
        assert found[i]["base_score"] == pytest.approx(r["base_score"], rel=1e-9) and found[i]["score"] == pytest.approx(r["score"], rel=1e-9)


@pytest.mark.parametrize("order", [1, 2])
def test_lm_of_lower_orders(spark, order):
    docs = spark.createDataFrame([(i, "a b a b c " * (i + 1)) for i in range(9)], "doc_id long, text string")
    rows = lm.scored(docs, order=order).collect()
    assert len(rows) == 9 and all((r["score"] == pytest.approx(r["base_score"])) == (order == 1) for r in rows)


def test_lm_packing():
    keys = np.array([0, 1, 1 << 20, 1 << 62], np.int64)
    assert (lm.unpacked_sorted(lm.packed_sorted(keys)) == keys).all() and (lm.unpacked(lm.packed(-keys)) == -keys).all()
    assert not len(lm.unpacked(lm.packed(keys[:0])))


def test_lm_probabilities_add_up_to_one():
    ids, shift, none = np.array([0, 1, 2, 3, -1]), lm.BITS, np.zeros(0, np.int64)
    # Words a b c, the end, and one that is unknown; known are a a, a b, b c and a b c.
    pairs = [np.array([0, 1, 1 << shift | 2]), np.array([2, 3, 2]), np.array([7, 5, 9]), np.array([0, 2, 0]), np.array([0, 1, 0])]
    triples = [np.array([5 << shift | 2]), np.array([2]), np.array([0]), none, none]
    unit = SimpleNamespace(ids=ids, counts=np.array([6, 4, 3, 2, 0]), sums=np.array([5, 2, 0, 0, 0]), kinds=np.array([2, 1, 0, 0, 0]), grams=[pairs, triples])
    automaton = lm.Automaton(unit, 15, 4)
    for before in ([], [0], [1], [0, 1], [2]):
        each = [10 ** automaton.score([*before, i], len(before)) for i in range(5)]
        assert sum(each) == pytest.approx(1.0)


def test_pieces(spark):
    found = result(spark, "op2_sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    for i, text, _ in documents():
        assert found[i]["ids"] == library.encode(text) and found[i]["n_pieces"] == len(found[i]["ids"]) and found[i]["round_trip"]


def test_mix(spark):
    found = result(spark, "op10_source_mixing")
    by_source = {}
    for i, text, source in documents():
        assert found[i]["size"] == len(WORD.findall(text)) and 0 <= found[i]["taken"] <= 3 * found[i]["size"]
        by_source.setdefault(source, []).append(found[i])
    total = sum(r["size"] for r in found.values())
    assert sum(rows[0]["target"] for rows in by_source.values()) == pytest.approx(total)
    for rows in by_source.values():
        assert abs(sum(r["taken"] for r in rows) - rows[0]["target"]) <= 16 * 16
        assert rows[0]["target"] <= 3 * rows[0]["source_size"] == 3 * sum(r["size"] for r in rows)


def test_small_sources_come_within_a_block_of_their_targets(spark):
    rows = [(s * 100 + k, "a b c d e", f"s{s:02d}") for s in range(40) for k in range(10)]
    rows += [(9000 + k, "w " * 200, "large") for k in range(100)] + [(9900, "one two three", "tiny"), (9901, None, "none"), (9902, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mixed(df).collect()
    by_source = {}
    for r in out:
        assert 0 <= r["taken"] <= 3 * r["size"]
        by_source.setdefault(r["source"], []).append(r)
    assert len(by_source) == 44
    for rows in by_source.values():
        # What rounding leaves over goes to the highest quotients, those of the large source.
        near = max(mixing.BLOCK, rows[0]["target"] / 50)
        assert abs(sum(r["taken"] for r in rows) - rows[0]["target"]) <= near
    drawn = mixing.drawn(df).groupBy("source").agg(F.sum(F.size(common.split_words(F.col("text")))).alias("n")).collect()
    assert {r["source"]: r["n"] for r in drawn} == {s: n for s, rows in by_source.items() if (n := sum(r["taken"] for r in rows))}


def test_quality_agrees_with_labels(spark):
    found = result(spark, "op9_quality_rules")
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SMALL}/labels.parquet'").fetchall())
    clean = [found[i] for i, q in labels.items() if q == 1 and not found[i]["base_failed"]]
    junk = [found[i] for i, q in labels.items() if q == 0]
    assert all(r["kept"] for r in clean) and not any(r["kept"] for r in junk)


def test_pipeline(spark):
    """Each stage on all that the one before has kept."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SMALL).cache()
        kept[name] = {r["doc_id"] for r in docs.collect()}
        assert kept[name] <= {r["doc_id"] for r in before.select("doc_id").collect()}
        if name != "SentencePiece":
            assert docs.columns == spark.read.parquet(f"{SMALL}/documents.parquet").columns
    verdicts = {r["doc_id"] for r in quality.judged(spark.read.parquet(f"{SMALL}/documents.parquet")).where("kept").collect()}
    assert kept["quality rules"] == kept["line dedup"] == verdicts
    assert kept["SimHash near-dedup"] < verdicts and kept["SentencePiece"] == kept["source mixing"]
    whole = contract.queries()["pipeline"](spark, SMALL)
    assert whole.columns == ["doc_id", "n_pieces", "ids", "round_trip"]
    rows = lambda df: sorted((r["doc_id"], tuple(r["ids"]), r["round_trip"]) for r in df.collect())
    assert rows(whole) == rows(docs) and all(r[2] for r in rows(docs))


def test_near_dedup_keeps_the_first(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = {r["id"] for r in simhash.classes(docs).where("id = component_id").collect()}
    assert {r["doc_id"] for r in simhash.one_of_each(docs).collect()} == found
