"""Source divergence audit: term counts of sources compared within each language, through transducer vocabularies."""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_words, joined, materialise, running_total, table

#: A term is kept in a language if so many of its documents have it, and a source's list of terms has so many ranks.
DOCUMENTS, RANKS = 3, 200
SCALE = 1_000_000_000
#: Bytes of text and different terms of a part, and bytes of a packet of it.
PART, TERMS, PACKET = 1 << 25, 1 << 19, 1 << 20
#: Terms in a row of a part's list.
LISTED = 1 << 14
#: Sources of a block and ordinals of a slice: two blocks are compared over one slice at once, so many columns at a time.
BLOCK, SLICE, COLUMNS = 64, 1 << 13, 1 << 10
#: Places that the terms of one source are spread over when they meet the source's own figures.
SPREAD = 16

#: Terms are runs of ASCII letters and of all other characters beyond ASCII, A-Z in lower case; the rest is space.
_SAME = bytes(range(256))
_LETTERS = bytes(ord(chr(b).lower()) if chr(b) in string.ascii_letters else b if b > 127 else 32 for b in range(256))


class Transducer:
    """Minimal acyclic transducer of sorted terms: it reads a term and adds up to the term's ordinal among them.

    Terms are added in order. When the next one leaves the last one's path, the states behind the fork are complete: each
    is replaced by an equal one if there is one. A state knows how many terms end behind it, so an arc's output is the
    number of terms that pass its state by earlier ways.
    """

    def __init__(self, terms: list[bytes]):
        known: dict[tuple[int, ...], int] = {}
        ends: list[int] = []
        final: list[int] = []
        keys, to, out = [], [], []

        def close(node: list[int]) -> int:
            """The state of a finished node: whether a term ends there, then its arcs as target << 8 | label."""
            key = tuple(node)
            state = known.get(key)
            if state is None:
                state = known[key] = len(final)
                before = node[0]
                final.append(before)
                for arc in node[1:]:
                    keys.append(state << 8 | arc & 255)
                    to.append(arc >> 8)
                    out.append(before)
                    before += ends[arc >> 8]
                ends.append(before)
            return state

        path: list[list[int]] = [[0]]
        last = b""
        for term in [*terms, b""]:
            fork, most = 0, min(len(last), len(term))
            while fork < most and last[fork] == term[fork]:
                fork += 1
            for depth in range(len(last), fork, -1):
                node = path.pop()
                state = known.get(tuple(node))
                if state is None:
                    state = close(node)
                path[-1].append(state << 8 | last[depth - 1])
            if not term:
                break
            path += [[0] for _ in range(len(term) - fork)]
            path[-1][0] = 1
            last = term
        self.root = close(path[0])
        self.size = ends[self.root]
        self.final = np.array(final, dtype=bool)
        self.keys, self.to, self.out = (np.array(x, dtype=np.int64) for x in (keys, to, out))
        self._place()

    def _place(self) -> None:
        """A table that finds an arc by its state and label, with open addressing."""
        bits = max(4, int(2 * len(self.keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slots = np.full(1 << bits, -1, dtype=np.int64)
        at, left = self._first(self.keys), np.arange(len(self.keys))
        while len(left):
            free = left[self.slots[at[left]] < 0]
            self.slots[at[free]] = free
            left = left[self.slots[at[left]] != left]
            at[left] = (at[left] + 1) & self.mask

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).view(np.int64)

    def _arcs(self, keys: np.ndarray) -> np.ndarray:
        """The arc of each state and label, or -1."""
        at, found, live = self._first(keys), np.full(len(keys), -1, dtype=np.int64), np.arange(len(keys))
        while len(live):
            arc = self.slots[at[live]]
            live, arc = live[arc >= 0], arc[arc >= 0]
            hit = self.keys[arc] == keys[live]
            found[live[hit]] = arc[hit]
            live = live[~hit]
            at[live] = (at[live] + 1) & self.mask
        return found

    def ordinals(self, text: bytes) -> np.ndarray:
        """The ordinals of the terms in a text whose terms stand between spaces; what isn't a term has none."""
        found = self.read(arrow_words(pa.array([text], pa.binary()), _SAME)[0])
        return found[found >= 0]

    def read(self, words: pa.Array) -> np.ndarray:
        """The ordinal of each word, minus one for what isn't a term.

        All words are read side by side, a byte of each at a time; a word without an arc drops out.
        """
        words = words.cast(pa.large_binary())
        _, offsets, data = words.buffers()
        raw = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)
        offsets = np.frombuffer(offsets, dtype=np.int64)[words.offset : words.offset + len(words) + 1]
        found = np.full(len(words), -1, dtype=np.int64)
        which = np.flatnonzero(np.diff(offsets))
        at, stop = offsets[which], offsets[which + 1]
        state, sums = np.full(len(at), self.root), np.zeros(len(at), dtype=np.int64)
        while len(at):
            arc = self._arcs(state << 8 | raw[at]) if len(self.keys) else np.full(len(at), -1)
            on = arc >= 0
            at, stop, which, arc = at[on] + 1, stop[on], which[on], arc[on]
            state, sums = self.to[arc], sums[on] + self.out[arc]
            ended = at == stop
            told = ended & self.final[state]
            found[which[told]] = sums[told]
            at, stop, which, state, sums = at[~ended], stop[~ended], which[~ended], state[~ended], sums[~ended]
        return found


def parts(docs: DataFrame, lang: str, source: str, text: str) -> DataFrame:
    """Texts in parts of bounded size. A row is a packet of one source's text in a part, or a part's terms of a language.

    ``terms`` has each term once with ``docs``, the part's documents that have it. Packets have terms between spaces, and
    long texts are cut between terms; a source without terms has an empty packet.
    """
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"),
    )
    schema = "part long, lang string, source string, packet binary, size long, terms array<binary>, docs array<long>"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        press = zstandard.ZstdCompressor(level=3)
        held: dict[tuple[str, str], list[bytes]] = {}
        seen: dict[str, Counter[bytes]] = {}
        size = 0
        types = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int64())]
        names = ["part", "lang", "source", "packet", "size", "terms", "docs"]

        def out() -> Iterator[pa.RecordBatch]:
            """Rows of a part, few at once; what has been passed on is let go."""
            while held:
                (lang, source), texts = held.popitem()
                whole, at = b" ".join(texts), 0
                while True:
                    end = whole.find(b" ", at + PACKET)
                    end = len(whole) if end < 0 else end
                    row = (number, lang, source, press.compress(whole[at:end]), end - at, None, None)
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)
                    at = end + 1
                    if at >= len(whole):
                        break
            while seen:
                lang, count = seen.popitem()
                each = iter(count.items())
                while some := list(islice(each, LISTED)):
                    row = (number, lang, None, None, None, [t for t, _ in some], [n for _, n in some])
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

        for batch in batches:
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang, source, text in zip(langs, sources, batch.column(2)):
                words = text.as_py().translate(_LETTERS).split()
                count = seen.setdefault(lang, Counter())
                count.update(set(words))
                line = b" ".join(words)
                held.setdefault((lang, source), []).append(line)
                size += len(line)
                if size >= PART or len(count) >= TERMS:
                    yield from out()
                    size, number = 0, number + 1
        if held:
            yield from out()

    return rows.mapInArrow(cut, schema)


def _recounted(packets: pa.Table, terms: pa.Table) -> pa.Table:
    """Counts of a part's kept terms by language and source: its packets are read by a transducer of each language."""
    unpress = zstandard.ZstdDecompressor()
    rows = []
    # One language after the other, so one transducer is held at once.
    for lang in terms.column("of").unique().to_pylist():
        mine = terms.filter(pc.equal(terms.column("of"), lang)).sort_by("term")
        listed = joined(mine.column("term").combine_chunks().cast(pa.large_binary()))
        machine, ordinals = Transducer(listed.split(b" ")), mine.column("ordinal").to_numpy()
        texts = packets.filter(pc.equal(packets.column("lang"), lang))
        told: dict[str, np.ndarray] = {}
        for source, packet in zip(texts.column("source").to_pylist(), texts.column("packet")):
            words = arrow_words(pa.array([unpress.decompress(packet.as_py())], pa.binary()), _SAME)[0].dictionary_encode()
            # A word that occurs often in a packet is read once.
            found = machine.read(words.dictionary)[words.indices.to_numpy()]
            counts = np.bincount(found[found >= 0], minlength=machine.size)
            told[source] = told.get(source, 0) + counts
        for source, counts in told.items():
            some = np.flatnonzero(counts)
            names = [pa.repeat(pa.scalar(x), len(some)) for x in (lang, source)]
            rows.append(pa.table([*names, pa.array(ordinals[some]), pa.array(counts[some])], names=COUNTS.names))
    return pa.concat_tables([COUNTS.empty_table(), *rows]).combine_chunks()


COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("ordinal", pa.int64()), ("n", pa.int64())])


def share(n: str, total: str, kept: str) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + kept)), exactly: in whole numbers of 64 bits where they hold the product."""
    wide = f"(cast({SCALE} AS decimal(18,0)) * cast({n} + 1 AS decimal(20,0))) div cast({total} + {kept} AS decimal(20,0))"
    return F.expr(f"1 + CASE WHEN {n} < {(1 << 63) // SCALE - 1} THEN ({SCALE} * cast({n} + 1 AS bigint)) div ({total} + {kept}) ELSE {wide} END")


def _distance(p: str, q: str) -> Column:
    """floor((p - q) ** 2 / q): at most 10 ** 18, so a long."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def _blocks(rows: pa.Table) -> pa.Table:
    """What two blocks of sources differ by over a slice of ordinals, beside what they differ by where neither has a term.

    Every source of the blocks has a row of ordinal -1: where it lacks a term, its share of an unseen one stands in.
    """
    place, block, ordinal, p, none = (rows.column(c).to_numpy() for c in ("place", "block", "ordinal", "p", "none"))
    places, first, row = np.unique(place, return_index=True, return_inverse=True)
    none, block, real = none[first], block[first], ordinal >= 0
    ordinals, at = np.unique(ordinal[real], return_inverse=True)
    a_side, b_side = rows.column("a")[0].as_py(), rows.column("b")[0].as_py()
    full = np.repeat(none[:, None], len(ordinals), axis=1)
    full[row[real], at] = p[real]
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for mine, theirs in {(a_side, b_side), (b_side, a_side)}:
        other = np.flatnonzero(block == theirs)
        if not len(other):
            continue
        for i in np.flatnonzero(block == mine):
            base = (none[i] - none[other]) ** 2 // none[other]
            total = np.zeros(len(other), dtype=np.int64)
            for c in range(0, len(ordinals), COLUMNS):
                q = full[other, c : c + COLUMNS]
                total += ((full[i, c : c + COLUMNS] - q) ** 2 // q - base[:, None]).sum(axis=1)
            out.append((np.full(len(other), places[i]), places[other], total))
    a, b, v = (np.concatenate([o[k] for o in out]) if out else np.zeros(0, np.int64) for k in range(3))
    keep = (a != b) & (v != 0)
    return pa.table({"x": a[keep], "y": b[keep], "more": v[keep]})


def audited(
    docs: DataFrame,
    documents: int = DOCUMENTS,
    ranks: int = RANKS,
    lang: str = "lang",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): how far each source of a language is from the others, and by what.

    A language keeps the terms that ``documents`` of its documents have. Part ``pair`` sets a source against each other one
    of its language, over all kept terms; part ``term`` lists the kept terms that a source has more of than its
    language, ``ranks`` at most. Equal values rank by the item's bytes, for terms by their ordinals.

    Null texts, languages and sources count as empty ones. Rows that repeat are documents each. A language without kept
    terms has pairs of value zero; a source alone in its language has no pairs; an empty table gives an empty result.
    Other columns aren't read.
    """
    cut = materialise(parts(docs, lang, source, text), "audit-parts")
    texts = cut.where("terms IS NULL")
    listed = cut.where("terms IS NOT NULL").select("part", "lang", F.explode(F.arrays_zip("terms", "docs")).alias("t"))
    listed = listed.select("part", "lang", F.col("t.terms").alias("term"), F.col("t.docs").alias("docs"))
    kept = listed.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= documents)
    one = kept.select("lang", "term", F.lit(1).cast("long").alias("one"))
    vocabulary = materialise(running_total(one, ["lang", "term"], "one", "audit-terms", "ordinal"), "audit-vocabulary")

    known = listed.join(vocabulary.select("lang", "term", "ordinal"), ["lang", "term"]).select(
        F.col("part").alias("at"), F.col("lang").alias("of"), "term", "ordinal"
    )
    counts = (
        texts.where("size > 0").select("part", "lang", "source", "packet").groupBy("part")
        .cogroup(known.groupBy("at"))
        .applyInArrow(_recounted, "lang string, source string, ordinal long, n long")
        # A part has a source's term once, so there is nothing to add up before the shuffle.
        .repartition("lang", "source", "ordinal").groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))
    )
    counts = materialise(counts, "audit-counts")

    sizes = vocabulary.groupBy("lang").agg(F.count("*").alias("kept"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = texts.groupBy("lang", "source").agg(F.lit(1).cast("long").alias("one"))
    groups = running_total(groups, ["lang", "source"], "one", "audit-sources", "place")
    groups = groups.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").na.fill(0, ["total", "kept"])
    unseen = F.when(F.col("kept") > 0, share("0", "total", "kept"))
    block = F.floor(F.col("place") / BLOCK)
    groups = groups.select("*", unseen.alias("none"), block.alias("block")).drop("one")
    # Sources stand in order of their languages, so a language has all blocks from its first to its last.
    spans = groups.groupBy("lang").agg(F.min("block").alias("low"), F.max("block").alias("high"))
    groups = materialise(groups.join(spans, "lang"), "audit-groups")
    shares = materialise(
        _with_figures(counts, groups, ["lang", "source"]).select(
            "lang", "source", "place", "block", "low", "high", "none", "ordinal", share("n", "total", "kept").alias("p")
        ),
        "audit-shares",
    )
    return _terms(counts, groups, shares, vocabulary, ranks).unionByName(_pairs(groups, shares))


def _with_figures(rows: DataFrame, figures: DataFrame, key: list[str]) -> DataFrame:
    """Join rows of terms with the figures of their source or language.

    One may have a third of all rows, so its figures go to several places and its terms are dealt among them.
    """
    salts = figures.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    return rows.withColumn("_salt", F.pmod(F.col("ordinal"), F.lit(SPREAD)).cast("int")).join(salts, [*key, "_salt"])


def _terms(counts: DataFrame, groups: DataFrame, shares: DataFrame, vocabulary: DataFrame, ranks: int) -> DataFrame:
    whole = counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("n"))
    sums = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("kept").alias("kept"))
    usual = _with_figures(whole, sums, ["lang"]).select("ordinal", share("n", "total", "kept").alias("q"))
    more = shares.join(usual, "ordinal").where("p > q").select("lang", "source", "ordinal", _distance("p", "q").alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    top = more.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= ranks)
    named = top.join(vocabulary.select("ordinal", F.col("term").cast("string").alias("item")), "ordinal")
    return named.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")


def _pairs(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """All pairs of sources of a language, which the result has a row for; terms are compared by blocks, never in pairs."""
    at = ("lang", F.floor(F.col("ordinal") / SLICE).alias("slice"))
    rows = shares.select(*at, "place", "block", "low", "high", "ordinal", "p", "none")
    # A source stands in each slice of its language, also where it has no term.
    slices = shares.select(*at).distinct()
    blank = groups.join(slices, "lang").select(
        "lang", "slice", "place", "block", "low", "high", F.lit(-1).cast("long").alias("ordinal"), F.col("none").alias("p"), "none"
    )
    sides = (F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"))
    more = (
        rows.unionByName(blank).withColumn("other", F.explode(F.sequence("low", "high")))
        .select("lang", *sides, "slice", "place", "block", "ordinal", "p", "none")
        .groupBy("lang", "a", "b", "slice").applyInArrow(_blocks, "x long, y long, more long")
        .groupBy("x", "y").agg(F.sum("more").alias("more"))
    )
    x = groups.select("lang", "source", "kept", F.col("place").alias("x"), F.col("none").alias("p"))
    y = groups.select("lang", F.col("source").alias("item"), F.col("place").alias("y"), F.col("none").alias("q"))
    each = x.join(y, "lang").where("x <> y").join(more, ["x", "y"], "left")
    value = F.coalesce(F.col("kept") * _distance("p", "q"), F.lit(0)) + F.coalesce("more", F.lit(0))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (
        each.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))
        .withColumn("rank", F.row_number().over(order))
    )


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited(table(spark, sf_dir, "documents").select("text", "lang", "source"))


OP11_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
w AS (SELECT rid, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
        '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS t FROM d),
k AS (SELECT lang, t FROM (SELECT DISTINCT rid, lang, t FROM w) GROUP BY lang, t HAVING count(*) >= {DOCUMENTS}),
v AS (SELECT lang, (SELECT count(*) FROM k WHERE k.lang = l.lang)::HUGEINT AS v FROM (SELECT DISTINCT lang FROM d) l),
c AS (SELECT lang, source, t, count(*)::HUGEINT AS n FROM w SEMI JOIN k USING (lang, t) GROUP BY lang, source, t),
g AS (SELECT d.lang, d.source, coalesce((SELECT sum(n) FROM c WHERE c.lang = d.lang AND c.source = d.source), 0)::HUGEINT AS n
      FROM (SELECT DISTINCT lang, source FROM d) d),
p AS (SELECT g.lang, g.source, k.t, coalesce(c.n, 0) AS n, 1 + ({SCALE}::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.n + v.v) AS p
      FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.t = k.t),
a AS (SELECT lang, t, sum(n)::HUGEINT AS n FROM c GROUP BY lang, t),
q AS (SELECT a.lang, a.t, 1 + ({SCALE}::HUGEINT * (a.n + 1)) // (s.n + v.v) AS q
      FROM a JOIN (SELECT lang, sum(n)::HUGEINT AS n FROM c GROUP BY lang) s USING (lang) JOIN v USING (lang)),
f AS (SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // y.p)::BIGINT AS value
      FROM p x JOIN p y ON x.lang = y.lang AND x.t = y.t AND x.source <> y.source GROUP BY x.lang, x.source, y.source),
pair AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(f.value, 0) AS value
         FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
         LEFT JOIN f ON f.lang = x.lang AND f.source = x.source AND f.item = y.source),
term AS (SELECT p.lang, p.source, 'term' AS part, p.t AS item, (((p - q) * (p - q)) // q)::BIGINT AS value
         FROM p JOIN q ON p.lang = q.lang AND p.t = q.t WHERE p.n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM (FROM pair UNION ALL FROM term))
SELECT * FROM r WHERE part = 'pair' OR rank <= {RANKS}
"""
