"""Embedding near-dedup: dual traversal of cover trees, exact pairs within a cosine threshold.

Distances are chords between unit vectors, so cosine 0.9 is distance 0.447. The upper levels of the tree are cells
around centers that all tasks know; cells are cut into blocks of bounded size, each block has nested levels of nodes with
halving radii, and pairs of blocks are traversed from coarse to fine. A pair of nodes is dropped if even the closest
points of the two are too far apart by their covering radii, and taken whole, without looking at points, if even
the farthest ones are close enough; only pairs between are opened, down to exact cosines of single vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import components, materialise, table

COSINE = 0.9
#: Vectors of a block at most twice this, on average; cells at most; vectors that cell centers are chosen from.
BLOCK, CELLS, SAMPLE = 8192, 512, 4096
#: Covering radii of the levels in a block.
RADII = (0.25, 0.125, 0.0625)
#: Bounds are trusted up to this; what is closer to the threshold is opened.
EPS = 1e-9
#: Vectors compared at once, and node pairs opened at once.
TILE, OPENED = 512, 1 << 18


def usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, and without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def units(vectors) -> np.ndarray:
    """Rows of length one, in double precision; scaled first, so squares neither overflow nor vanish."""
    x = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def chords(cosines: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosines))


def net(x: np.ndarray, radius: float, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows that are centers, more than ``radius`` apart, and for each row the number of a center within it.

    With ``most`` centers it stops, and rows further away get the number minus one.
    """
    near = 1.0 - radius * radius / 2.0
    centers: list[int] = []
    held = np.empty_like(x[: len(x) if most is None else most])
    owner = np.full(len(x), -1)
    for at in range(0, len(x), TILE):
        part = x[at : at + TILE]
        if centers:
            cosines = part @ held[: len(centers)].T
            best = cosines.argmax(axis=1)
            close = cosines[np.arange(len(part)), best] >= near
            owner[at : at + len(part)][close] = best[close]
        mine = owner[at : at + len(part)]
        among = part @ part.T
        for i in np.flatnonzero(mine < 0):
            if mine[i] < 0 and (most is None or len(centers) < most):
                mine[(mine < 0) & (among[i] >= near)] = len(centers)
                mine[i] = len(centers)
                held[len(centers)] = part[i]
                centers.append(at + int(i))
    return np.array(centers, dtype=np.int64), owner


def halving_centers(x: np.ndarray, most: int) -> np.ndarray:
    """Centers from the coarsest level on which nets give enough of them, cut to ``most``."""
    radius = 2.0
    while True:
        centers, _ = net(x, radius, most)
        if len(centers) >= most or len(centers) == len(x) or radius < RADII[-1]:
            return x[centers]
        radius /= 2


@dataclass
class Level:
    center: np.ndarray  # vectors
    radius: np.ndarray
    weight: np.ndarray
    start: np.ndarray  # of children, which stand together on the next level, and their number
    count: np.ndarray
    of_point: np.ndarray  # the node of each point
    links: np.ndarray = field(init=False)
    whole: np.ndarray = field(init=False)  # all points of the node are linked to something together
    inner: np.ndarray = field(init=False)  # all points of the node are linked to each other

    def __post_init__(self):
        n = len(self.weight)
        self.links, self.whole, self.inner = np.zeros(n), np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)


def levels(x: np.ndarray, weight: np.ndarray, path: np.ndarray) -> tuple[np.ndarray, list[Level]]:
    """The order in which points stand, and the levels over it; ``path``: each point's center on each level, as a row."""
    order = np.lexsort(path.T[::-1])
    x, weight, path, out = x[order], weight[order], path[order], []
    rows = np.arange(len(x))
    place = np.empty(len(x), dtype=np.int64)
    place[order] = rows
    new = np.zeros(len(x), dtype=bool)
    for k in range(path.shape[1]):
        new |= np.r_[True, path[1:, k] != path[:-1, k]]
        of_point = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        center = x[place[path[first, k]]]
        away = chords(np.einsum("ij,ij->i", x, center[of_point]))
        out.append(Level(center, np.maximum.reduceat(away, first), np.add.reduceat(weight, first), first, np.diff(np.r_[first, len(x)]), of_point))
    for upper, lower in zip(out, out[1:]):
        # Children are counted in nodes of the next level instead of points.
        stop = lower.of_point[upper.start + upper.count - 1] + 1
        upper.start = lower.of_point[upper.start]
        upper.count = stop - upper.start
    out.append(Level(x, np.zeros(len(x)), weight.astype(float), rows, np.ones(len(x), dtype=np.int64), rows))
    return order, out


def _join(up: list[int], a: int, b: int) -> None:
    while up[a] != a:
        up[a] = up[up[a]]
        a = up[a]
    while up[b] != b:
        up[b] = up[up[b]]
        b = up[b]
    if a != b:
        up[max(a, b)] = min(a, b)


def traverse(left: list[Level], right: list[Level] | None, cosine: float) -> tuple[list[int], np.ndarray, np.ndarray]:
    """A forest over the points of both sides, and the weight each is linked to; one side alone with itself if right is None."""
    far, same = math.sqrt(2.0 - 2.0 * cosine), right is None
    other = left if same else right
    n = len(left[-1].weight)
    up = list(range(n if same else n + len(other[-1].weight)))
    shift = 0 if same else n
    last = len(left) - 1

    def firsts(side: list[Level], k: int) -> np.ndarray:
        """The first point of each node."""
        return np.searchsorted(side[k].of_point, np.arange(len(side[k].weight)))

    begin = [(firsts(left, k), firsts(other, k)) for k in range(last + 1)]

    def settle(k: int, a: np.ndarray, b: np.ndarray, cosines: np.ndarray) -> None:
        p, q = left[k], other[k]
        if k == last:
            hit = (cosines >= cosine) & ((a != b) if same else True)
            take, open_ = hit, np.zeros_like(hit)
        else:
            d, both = chords(cosines), p.radius[a] + q.radius[b]
            take = d + both <= far - EPS
            open_ = ~take & (d - both <= far + EPS)
        ta, tb = a[take], b[take]
        np.add.at(p.links, ta, q.weight[tb])
        p.whole[ta] = True
        alone = (ta == tb) if same else np.zeros(len(ta), dtype=bool)
        p.inner[ta[alone]] = True
        np.add.at(q.links, tb[~alone], p.weight[ta[~alone]])
        q.whole[tb] = True
        for x, y in zip(begin[k][0][ta[~alone]].tolist(), begin[k][1][tb[~alone]].tolist()):
            _join(up, x, y + shift)
        if open_.any():
            deeper(k, a[open_], b[open_])

    def deeper(k: int, a: np.ndarray, b: np.ndarray) -> None:
        """All pairs of children, a bounded number at a time; a node with itself gives each pair of children once."""
        p, q = left[k], other[k]
        sizes = p.count[a] * q.count[b]
        ends = np.cumsum(sizes)
        at = 0
        while at < len(a):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + OPENED)))
            part = slice(at, stop)
            n_, total = sizes[part], int(sizes[part].sum())
            which = np.repeat(np.arange(stop - at), n_)
            local = np.arange(total) - np.repeat(np.cumsum(n_) - n_, n_)
            wide = q.count[b[part]][which]
            ca, cb = p.start[a[part]][which] + local // wide, q.start[b[part]][which] + local % wide
            if same:
                keep = ca <= cb
                ca, cb = ca[keep], cb[keep]
            for t in range(0, len(ca), OPENED):
                i, j = ca[t : t + OPENED], cb[t : t + OPENED]
                settle(k + 1, i, j, np.einsum("ij,ij->i", left[k + 1].center[i], other[k + 1].center[j]))
            at = stop

    top, under = left[0], other[0]
    for at in range(0, len(top.weight), TILE):
        cosines = top.center[at : at + TILE] @ under.center.T
        bound = far + EPS + top.radius[at : at + TILE, None] + under.radius[None, :]
        # Chord <= bound, written for cosines; chords end at two.
        a, b = np.nonzero(cosines >= 1.0 - np.minimum(bound, 2.0) ** 2 / 2.0 - 1e-12)
        if same:
            a, b = a[a + at <= b], b[a + at <= b]
        settle(0, a + at, b, cosines[a, b])

    out = []
    for side in (left, other):
        got = np.zeros(len(side[-1].weight))
        for level in side:
            # A node linked with itself has given each of its points that point's own weight, too.
            got += level.links[level.of_point] - level.inner[level.of_point] * side[-1].weight
        out.append(got)
    for side, place in ((left, 0),) if same else ((left, 0), (other, n)):
        for level in side[:-1]:
            points = np.flatnonzero(level.whole[level.of_point])
            heads = np.searchsorted(level.of_point, level.of_point[points])
            for x, y in zip(points.tolist(), heads.tolist()):
                _join(up, x + place, y + place)
    return up, out[0], out[1]


def _vectors(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.float64).reshape(len(column), -1)


def _built(block: pd.DataFrame) -> pd.DataFrame:
    """Centers of each point on the levels of its block's tree, as numbers in the block."""
    block = block.sort_values("node").reset_index(drop=True)
    x = _vectors(block["unit"])
    groups = {0: np.arange(len(x))}
    path = np.empty((len(x), len(RADII)), dtype=np.int64)
    for k, radius in enumerate(RADII):
        found: dict[int, np.ndarray] = {}
        for center, rows in groups.items():
            if len(rows) == 1:
                path[rows, k] = rows
                found[int(rows[0])] = rows
                continue
            if k:  # a node's center is one of its children's
                rows = np.r_[center, rows[rows != center]]
            centers, owner = net(x[rows], radius)
            path[rows, k] = rows[centers[owner]]
            by = np.argsort(owner, kind="stable")
            for part in np.split(rows[by], np.flatnonzero(np.diff(owner[by])) + 1):
                found[int(path[part[0], k])] = part
        groups = found
    return block.assign(number=np.arange(len(x)), path=list(path))


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row for each row of ``vectors``: id, n_links, component_id.

    Linked are rows whose cosine, in double precision, is at least ``cosine``; ``n_links`` counts the other rows linked
    to a row directly, ``component_id`` is the smallest id reachable by links, itself included. Vectors that are null,
    empty, zero, or hold null or non-finite components link with nothing, and vectors of different lengths don't link.
    Rows that repeat are rows like any other. Null ids are the smallest only where there is no other. Nothing is sampled
    but the rows that cell centers are chosen from, which affects the work and not the result.

    Equal vectors are compared once, with a weight. Links within a block pair reach Spark as a sum for each vector and a
    spanning forest, never pair by pair.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(vec_id).alias("id"), F.col(vector).alias("v"))
    same = (
        rows.where(usable(F.col("v"))).groupBy("v").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    )
    same = materialise(same.withColumn("node", F.monotonically_increasing_id()).withColumn("dim", F.size("v")), "vectors")
    sizes = {r["dim"]: r["count"] for r in same.groupBy("dim").count().collect()}
    centers: list[tuple[int, np.ndarray]] = []
    for dim, count in sizes.items():
        few = same.where(F.col("dim") == dim).orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("v")
        found = halving_centers(units([r["v"] for r in few.collect()]), min(CELLS, -(-count // BLOCK)))
        centers += [(dim, c) for c in found]
    shared = spark.sparkContext.broadcast(centers)

    def assigned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by_dim = {d: np.array([c for e, c in shared.value if e == d]) for d in {e for e, _ in shared.value}}
        base = {d: next(i for i, (e, _) in enumerate(shared.value) if e == d) for d in by_dim}
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                x = units(part["v"])
                cosines = x @ by_dim[dim].T
                best = cosines.argmax(axis=1)
                away = chords(cosines[np.arange(len(x)), best])
                yield pd.DataFrame({"node": part["node"], "n": part["n"], "cell": best + base[dim], "away": away, "unit": [v.tobytes() for v in x]})

    held = materialise(
        same.select("node", "n", "dim", "v").mapInPandas(assigned, "node long, n long, cell int, away double, unit binary"), "cells"
    )
    cells = {r["cell"]: (r["n"], r["r"]) for r in held.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("r")).collect()}
    if not cells:
        return rows.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    # Large cells are cut into blocks by hash; blocks are numbered cell by cell.
    parts = {c: -(-n // BLOCK) for c, (n, _) in cells.items()}
    first, blocks = {}, []
    for c in sorted(parts):
        first[c] = len(blocks)
        blocks += [c] * parts[c]
    cuts = spark.createDataFrame([(c, first[c], parts[c]) for c in parts], "cell int, base int, parts int")
    with_block = held.join(F.broadcast(cuts), "cell").withColumn(
        "block", (F.col("base") + F.pmod(F.xxhash64("node"), F.col("parts"))).cast("int")
    )
    built = materialise(
        with_block.select("block", "cell", "node", "n", "unit")
        .groupBy("block")
        .applyInPandas(_built, "block int, cell int, node long, n long, unit binary, number long, path array<long>"),
        "blocks",
    )
    far, count = math.sqrt(2.0 - 2.0 * cosine), len(blocks)
    radius = {c: r for c, (_, r) in cells.items()}

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each vector goes to the pairs of its block with those whose cells can hold a partner."""
        of_block = np.array(blocks)
        at = np.array([radius[c] for c in blocks])
        for batch in batches:
            for cell, part in batch.groupby("cell"):
                dim = shared.value[cell][0]
                mine = np.array([shared.value[c][0] == dim for c in blocks])
                here = np.array([shared.value[c][1] if ok else np.zeros(dim) for c, ok in zip(of_block, mine)])
                near = chords(_vectors(part["unit"]) @ here.T) <= at + far + EPS
                near &= mine
                row, to = np.nonzero(near | (part["block"].to_numpy()[:, None] == np.arange(count)))
                own = part["block"].to_numpy()[row]
                out = part.iloc[row].assign(low=np.minimum(own, to), high=np.maximum(own, to), left=own <= to)
                yield out[["low", "high", "left", "node", "n", "unit", "number", "path"]]

    def linked(pair: pd.DataFrame) -> pd.DataFrame:
        same_block = pair["low"].iloc[0] == pair["high"].iloc[0]
        sides = [_side(pair[pair["left"]])] + ([] if same_block else [_side(pair[~pair["left"]])])
        empty = pd.DataFrame({"node": np.zeros(0, np.int64), "root": np.zeros(0, np.int64), "links": np.zeros(0, np.int64)})
        if any(not len(nodes) for nodes, _ in sides):
            return empty
        up, a, b = traverse(sides[0][1], None if same_block else sides[1][1], cosine)
        nodes = np.concatenate([s[0] for s in sides])
        links = a if same_block else np.concatenate([a, b])
        root = np.array([_root(up, i) for i in range(len(up))])
        told = (links > 0) | (root != np.arange(len(root)))
        return pd.DataFrame({"node": nodes[told], "root": nodes[root[told]], "links": np.rint(links[told]).astype(np.int64)})

    found = materialise(
        built.mapInPandas(spread, "low int, high int, left boolean, node long, n long, unit binary, number long, path array<long>")
        .groupBy("low", "high")
        .applyInPandas(linked, "node long, root long, links long"),
        "vector-links",
    )
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), "vectors")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = same.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).join(links, "node", "left")
    best = known.groupBy("root").agg(F.min("first").alias("component_id"))
    told = known.join(best, "root").select("v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    good = rows.where(usable(F.col("v"))).join(told, "v").select("id", "n_links", "component_id")
    return good.union(rows.where(~usable(F.col("v"))).select("id", F.lit(0).cast("long"), "id"))


def _root(up: list[int], i: int) -> int:
    while up[i] != i:
        up[i] = up[up[i]]
        i = up[i]
    return i


def _side(rows: pd.DataFrame) -> tuple[np.ndarray, list[Level]]:
    """Vectors of a block that were sent to a pair, in the order of their tree, and its levels."""
    if not len(rows):
        return np.zeros(0, np.int64), []
    rows = rows.sort_values("number")
    number, path = rows["number"].to_numpy(), np.array(rows["path"].tolist(), dtype=np.int64)
    # A center that was not sent is replaced by the first of its points that was.
    place = {int(v): i for i, v in enumerate(number)}
    local = np.empty_like(path)
    for k in range(path.shape[1]):
        heads: dict[int, int] = {}
        for i, c in enumerate(path[:, k].tolist()):
            if c not in heads:
                heads[c] = place.get(c, i)
            local[i, k] = heads[c]
    order, tree = levels(_vectors(rows["unit"]), rows["n"].to_numpy().astype(float), local)
    return rows["node"].to_numpy()[order], tree


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = near_duplicates(rows)
    return found.select(
        F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )
