"""Exact top-k by inner product with ball trees, one for each shard of the vectors.

A node keeps the centre and the radius of a ball around its vectors. No inner product with a query q in it is larger than
q·centre + |q|·radius. A query goes through the nodes by this bound, the largest first, and stops at a bound below its
current k-th score: what is left can hold nothing better.

Shards follow the same rule. The top of a tree, grown on a bounded sample, deals all vectors over cells; a cell is cut into
shards by hash where it is large. A shard's tree is built once and stored. A query first searches the cell of its largest
bound; the k-th score found there is shared with all other cells: those whose bound is below it are not searched, and the
rest start with it as their own k-th score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import cut, quoted, scratch, table

LEAF = 64
#: Vectors of a shard: at most MOST, and at most so many that they hold COMPONENTS components.
MOST, COMPONENTS = 16_384, 2**23
#: Queries that visit a shard together; more are dealt over several blocks.
BLOCK = 32_768
#: Queries that a task holds bounds for at once.
BATCH = 4096
#: Vectors that the cells are grown on, about (chosen by hash; twice as many at most), and cells at most.
SAMPLE, CELLS = 4096, 64
#: Below every score.
LOWEST = -(2**63)


def _extremes(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """x's places along the line from the row farthest from the centre to the row farthest from that one."""
    a = x[((x - centre) ** 2).sum(axis=1).argmax()]
    b = x[((x - a) ** 2).sum(axis=1).argmax()]
    return x @ (b - a)


def bounds(q: np.ndarray, centre: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """(query, node): no score of the node's vectors is larger, with a margin for rounding."""
    norm = np.sqrt((q * q).sum(axis=1))[:, None]
    far = np.sqrt((centre * centre).sum(axis=1))[None, :] + radius[None, :]
    return q @ centre.T + norm * radius[None, :] + 1e-9 * norm * far + 1e-6


@dataclass
class Tree:
    """A ball tree whose node i has the children 2i + 1 and 2i + 2; a node's rows are order[edge[i, 0]:edge[i, 1]]."""

    order: np.ndarray
    edge: np.ndarray
    centre: np.ndarray
    radius: np.ndarray


def build(x: np.ndarray) -> Tree:
    """The tree over x's rows. Every node is halved, so copies of one vector make no deep branch and no large leaf."""
    depth = max(0, math.ceil(math.log2(max(1, len(x) / LEAF))))
    nodes = 2 ** (depth + 1) - 1
    tree = Tree(np.arange(len(x)), np.zeros((nodes, 2), np.int64), np.zeros((nodes, x.shape[1])), np.zeros(nodes))
    tree.edge[0] = 0, len(x)
    for i in range(nodes):
        lo, hi = tree.edge[i]
        part = x[tree.order[lo:hi]]
        tree.centre[i] = part.mean(axis=0)
        tree.radius[i] = math.sqrt(((part - tree.centre[i]) ** 2).sum(axis=1).max())
        if 2 * i + 2 < nodes:
            tree.order[lo:hi] = tree.order[lo:hi][np.argsort(_extremes(part, tree.centre[i]), kind="stable")]
            middle = (lo + hi + 1) // 2
            tree.edge[2 * i + 1], tree.edge[2 * i + 2] = (lo, middle), (middle, hi)
    return tree


class Search:
    """The k best of a shard for a batch of queries. x: the shard's integer vectors in the order of its tree; own: the id that a
    query must not find; shared: a score that what is found must reach."""

    def __init__(self, tree: Tree, ids: np.ndarray, x: np.ndarray, q: np.ndarray, own: np.ndarray, shared: np.ndarray, k: int) -> None:
        self.tree, self.ids, self.own, self.k, self.shared = tree, ids, own, k, shared
        largest = x.shape[1] * max(map(int, (np.abs(x).max(initial=0), 1))) * max(map(int, (np.abs(q).max(initial=0), 1)))
        if largest >= 2**63:
            raise ValueError("components too large: a score may not fit into 64 bits")
        self.kind = np.float64 if largest < 2**53 else np.int64  # the first is exact below 2**53, and faster
        self.x, self.q = x.astype(self.kind), q.astype(self.kind)
        self.score = np.full((len(q), k), LOWEST)
        self.found = np.full((len(q), k), np.iinfo(np.int64).max)
        self.compared = 0

    def limit(self) -> np.ndarray:
        return np.maximum(self.shared, self.score[:, -1])

    def run(self) -> None:
        """Down the levels to the leaves that the shared score reaches, then through each query's leaves by their bounds: one, the
        next two, the next four, ..., as long as their bound reaches the current k-th score."""
        q, t = self.q.astype(np.float64), self.tree
        leaves = (len(t.radius) + 1) // 2
        alive, first, width = np.ones((len(q), 1), bool), 0, 1
        shared = self.shared.astype(np.float64)[:, None]
        while True:
            reach = np.full(alive.shape, -np.inf)
            rows, cols = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
            reach[np.ix_(rows, cols)] = bounds(q[rows], t.centre[first + cols], t.radius[first + cols])
            alive &= reach >= shared
            if width == leaves:
                break
            alive, first, width = np.repeat(alive, 2, axis=1), first + width, width * 2
        reach[~alive] = -np.inf
        order = np.argsort(-reach, axis=1, kind="stable")
        at, step = 0, 1
        while at < leaves:
            leaf = order[:, at : at + step]
            bound = np.take_along_axis(reach, leaf, axis=1)
            a, j = np.nonzero((bound > -np.inf) & (bound >= self.limit().astype(np.float64)[:, None]))
            if not len(a):
                break
            self._offer(a, leaf[a, j], first)
            at, step = at + step, step * 2

    def _offer(self, a: np.ndarray, leaf: np.ndarray, first: int) -> None:
        """Compare query a[i] with the vectors of leaf[i]; what may enter goes into the lists."""
        by = np.argsort(leaf, kind="stable")
        a, leaf = a[by], leaf[by]
        limit, hits = self.limit(), []
        for group in np.split(np.arange(len(a)), np.flatnonzero(np.diff(leaf)) + 1):
            lo, hi = self.tree.edge[first + leaf[group[0]]]
            who = a[group]
            s = (self.q[who] @ self.x[lo:hi].T).astype(np.int64)
            self.compared += s.size
            i, j = np.nonzero((s >= limit[who][:, None]) & (self.ids[lo:hi][None, :] != self.own[who][:, None]))
            hits.append((who[i], s[i, j], self.ids[lo + j]))
        who, s, ids = (np.concatenate(x) for x in zip(*hits, strict=True))
        old = np.unique(who)
        who = np.r_[who, np.repeat(old, self.k)]
        s, ids = np.r_[s, self.score[old].ravel()], np.r_[ids, self.found[old].ravel()]
        by = np.lexsort((ids, ~s, who))  # ~s falls as s rises, without overflow
        who, s, ids = who[by], s[by], ids[by]
        rank = np.arange(len(who)) - np.searchsorted(who, who, side="left")
        top = rank < self.k
        self.score[who[top], rank[top]], self.found[who[top], rank[top]] = s[top], ids[top]


@dataclass
class Split:
    """A node of the top that cells come from; a cell is its number."""

    along: np.ndarray
    at: float
    near: "Split | int"
    far: "Split | int"


def grow(x: np.ndarray, cells: int, centres: list[np.ndarray]) -> "Split | int":
    """The top of a tree over x with so many cells at most; centres gets the centre of each."""
    centre = x.mean(axis=0)
    if cells > 1 and len(x) > 1:
        a = x[((x - centre) ** 2).sum(axis=1).argmax()]
        along = x[((x - a) ** 2).sum(axis=1).argmax()] - a
        place = x @ along
        at = float(np.median(place))
        below = place < at
        if below.any():
            return Split(along, at, grow(x[below], cells // 2, centres), grow(x[~below], cells - cells // 2, centres))
    centres.append(centre)
    return len(centres) - 1


def cell_of(top: Split | int, x: np.ndarray) -> np.ndarray:
    if not isinstance(top, Split):
        return np.full(len(x), top, np.int32)
    out, below = np.empty(len(x), np.int32), x @ top.along < top.at
    out[below], out[~below] = cell_of(top.near, x[below]), cell_of(top.far, x[~below])
    return out


def usable(v: str) -> F.Column:
    """Not null, without null, NaN or infinite components."""
    return F.col(v).isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def whole(v: str, scale: int) -> F.Column:
    """floor(scale * x) of each component x, in double precision."""
    return F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))


def top_products(vectors: DataFrame, queries: DataFrame, key: str, vector: str, k: int = 5, scale: int = 256) -> DataFrame:
    """query_id, query_hash, rank (from 1), key, score: each query's k vectors of the same length and another key with the largest
    inner product of floor(scale * component).

    score is exact; ties go to the smaller key. Vectors null or with null or non-finite components and rows without a key take no
    part. Repeated rows are asked and found once; different vectors of one key are found each, and as queries have a list each
    (query_hash, a hash of the vector, tells them apart). Other columns are ignored, an empty table gives an empty result, fewer
    than k candidates give all. Components so large that a score might not fit into 64 bits raise an error."""

    with scratch() as keep:
        return keep(cut(_found(vectors, queries, key, vector, k, scale), "products"))


def _found(vectors: DataFrame, queries: DataFrame, key: str, vector: str, k: int, scale: int) -> DataFrame:
    def clean(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(quoted(key)).cast("long").alias("id"), F.col(quoted(vector)).alias("v")).filter(F.col("id").isNotNull() & usable("v"))
        return rows.select("id", whole("v", scale).alias("v")).dropDuplicates(["id", "v"]).withColumns({"dim": F.size("v"), "h": F.xxhash64("v")})

    base, asked = cut(clean(vectors), "base"), cut(clean(queries), "asked")
    n, m = base.count(), asked.count()
    blocks = max(1, -(-m // BLOCK))
    tops, centres = _tops(base, n, min(CELLS, -(-n // (MOST // 4))))

    def located(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows with their cell and their distance from its centre."""
        for pdf in it:
            for dim, part in pdf.groupby("dim", sort=False):
                x = np.stack(part.v.to_numpy()).astype(np.float64)
                cell = cell_of(tops.get(dim, 0), x)
                yield part.assign(cell=cell, off=np.sqrt(((x - centres[dim][cell]) ** 2).sum(axis=1)) if dim in centres else 0.0)

    own = cut(base.mapInPandas(located, "id bigint, v array<bigint>, dim int, h bigint, cell int, off double"), "cells")
    most = F.least(F.lit(MOST), F.greatest(F.lit(1), F.floor(F.lit(COMPONENTS) / F.greatest(F.lit(1), F.col("dim")))))
    sizes = cut(own.groupBy("dim", "cell").agg(F.ceil(F.count("*") / F.max(most)).cast("int").alias("shards"), F.max("off").alias("radius")), "sizes")
    balls: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    # lengths that the sample lacks have one cell and need no ball
    for dim, part in sizes.filter(F.col("dim").isin(list(centres))).toPandas().sort_values("cell").groupby("dim"):
        balls[int(dim)] = part.cell.to_numpy(), np.c_[centres[dim][part.cell.to_numpy()], part.radius.to_numpy(np.float64)]

    def store(pdf: pd.DataFrame) -> pd.DataFrame:
        """A shard in one row: its tree, and its vectors in the order of the tree."""
        pdf = pdf.sort_values("id", ignore_index=True)
        x = np.stack(pdf.v.to_numpy()).astype(np.int64)
        tree = build(x.astype(np.float64))
        kind = next((t for t in ("i2", "i4") if not x.size or np.iinfo(t).min <= x.min() and x.max() <= np.iinfo(t).max), "i8")
        said = {"ids": pdf.id.to_numpy(np.int64)[tree.order], "x": x[tree.order].astype(kind), "edge": tree.edge, "centre": tree.centre, "radius": tree.radius}
        return pd.DataFrame({**{c: [pdf[c].iloc[0]] for c in ("dim", "cell", "shard")}, "kind": [kind], **{c: [np.ascontiguousarray(v).tobytes()] for c, v in said.items()}})

    dealt = own.join(sizes.drop("radius"), ["dim", "cell"]).withColumn("shard", F.pmod(F.xxhash64("id", "h"), F.col("shards")).cast("int")).drop("shards", "off", "h")
    trees = cut(dealt.groupBy("dim", "cell", "shard").applyInPandas(store, "dim int, cell int, shard int, kind string, ids binary, x binary, edge binary, centre binary, radius binary"), "trees")

    def called(first: bool):  # noqa: ANN202
        """Queries with the cell of their largest bound, or with the others that their k-th score reaches."""

        def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in it:
                for dim, part in pdf.groupby("dim", sort=False):
                    if dim not in balls:
                        if first:
                            yield part.assign(cell=np.int32(0))
                        continue
                    cells, ball = balls[dim]
                    reach = bounds(np.stack(part.v.to_numpy()).astype(np.float64), ball[:, :-1], ball[:, -1])
                    home = reach.argmax(axis=1)
                    if first:
                        yield part.assign(cell=cells[home].astype(np.int32))
                    else:
                        reach[np.arange(len(part)), home] = -np.inf
                        i, j = np.nonzero((reach > -np.inf) & (reach >= part.shared.to_numpy(np.float64)[:, None]))
                        yield part.iloc[i].assign(cell=cells[j].astype(np.int32))

        return run

    def within(keys: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [np.empty(0, np.int64)], "query_hash": [np.empty(0, np.int64)], "id": [np.empty(0, np.int64)], "score": [np.empty(0, np.int64)]}
        if len(left) and len(right):
            row, dim = left.iloc[0], int(keys[0])
            ids, radius = np.frombuffer(row.ids, np.int64), np.frombuffer(row.radius, np.float64)
            x = np.frombuffer(row.x, row.kind).reshape(len(ids), dim).astype(np.int64)
            tree = Tree(np.arange(len(ids)), np.frombuffer(row.edge, np.int64).reshape(-1, 2), np.frombuffer(row.centre, np.float64).reshape(len(radius), dim), radius)
            for at in range(0, len(right), BATCH):
                part = right.iloc[at : at + BATCH]
                own_id, own_hash = part.id.to_numpy(np.int64), part.h.to_numpy(np.int64)
                search = Search(tree, ids, x, np.stack(part.v.to_numpy()).astype(np.int64), own_id, part.shared.to_numpy(np.int64), k)
                search.run()
                a, j = np.nonzero(search.score != LOWEST)
                for name, v in (("query_id", own_id[a]), ("query_hash", own_hash[a]), ("id", search.found[a, j]), ("score", search.score[a, j])):
                    out[name].append(v)
        return pd.DataFrame({c: np.concatenate(v) for c, v in out.items()})

    block = F.pmod(F.xxhash64("id", "h"), F.lit(blocks)).cast("int")

    def search(calls: DataFrame) -> DataFrame:
        """Finds of calls (id, v, dim, h, shared, cell), each in all shards of its cell."""
        calls = cut(calls.withColumn("block", block), "calls")
        wanted = trees.join(calls.select("dim", "cell", "block").distinct(), ["dim", "cell"])
        wanted = wanted.toDF(*wanted.columns)
        to = calls.join(sizes.drop("radius"), ["dim", "cell"]).withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).drop("shards")
        by = ("dim", "cell", "shard", "block")
        return wanted.groupBy(*by).cogroup(to.groupBy(*by)).applyInPandas(within, "query_id bigint, query_hash bigint, id bigint, score bigint")

    def best(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id", "query_hash").orderBy(F.col("score").desc(), "id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    kinds = "id bigint, v array<bigint>, dim int, h bigint, shared bigint, cell int"
    lowest = F.lit(LOWEST).cast("long")
    found = cut(best(search(asked.withColumn("shared", lowest).mapInPandas(called(True), kinds))), "found")
    if any(len(cells) > 1 for cells, _ in balls.values()):
        kth = found.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("query_hash").alias("h"), F.col("score").alias("shared"))
        rest = asked.join(kth, ["id", "h"], "left").select("id", "v", "dim", "h", F.coalesce("shared", lowest).alias("shared"))
        found = best(found.drop("rank").unionByName(search(rest.mapInPandas(called(False), kinds))))
    return found.select("query_id", "query_hash", F.col("rank").cast("int").alias("rank"), F.col("id").alias(key), "score")


def _tops(base: DataFrame, n: int, cells: int) -> tuple[dict[int, Split | int], dict[int, np.ndarray]]:
    """For each length of vectors in a sample the top of a tree, and the centres of its cells."""
    chosen = F.pmod(F.xxhash64("h", "id"), F.lit(max(1, n // SAMPLE))) == 0
    sample = base.filter(chosen).limit(2 * SAMPLE).select("dim", "v").toPandas()
    tops, centres = {}, {}
    for dim, part in sample.groupby("dim"):
        made: list[np.ndarray] = []
        tops[int(dim)] = grow(np.stack(part.v.to_numpy()).astype(np.float64), max(1, cells), made)
        centres[int(dim)] = np.stack(made)
    return tops, centres


def op11_ball_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    found = top_products(vectors, vectors.filter(F.col("vec_id") % 50 == 0), "vec_id", "embedding")
    return found.select("query_id", "rank", "vec_id", "score")
