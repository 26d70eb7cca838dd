"""Nearest neighbours by vantage-point trees, one for each shard of the vectors.

A node keeps a vantage point and the median distance to it. For a query at distance d from the vantage point, the far
half can hold nothing nearer than |d - median|; it is skipped if that exceeds factor times the distance of the k-th best
so far. With factor 1 the search is exact; a smaller factor skips more and may miss a neighbour.

Shards follow the same rule. The top of a tree, grown on a bounded sample, deals all vectors out over cells; a cell is
cut into shards by hash where it is large. A query first searches its own cell, and goes to the others that its bound
from there still reaches.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import cut, quoted, table

LEAF = 64
#: Vectors of a shard: LEAST at least, MOST at most, in between a 64th of all.
LEAST, MOST = 4096, 65_536
#: Queries that visit a tree together; more are dealt over several blocks, each with a copy of the shard.
BLOCK = 32_768
#: Vectors that the cells are grown on, about (chosen by hash; twice as many at most), and cells at most. What goes to every task is a vantage point a cell.
SAMPLE, CELLS = 4096, 64
#: The default factor: its recall at 10 is 0.99 on 51,282 spread-out vectors of 64 dimensions, where hardly any bound can prune.
FACTOR = 0.2
#: A bound that reaches every cell.
EVERYWHERE = 1e300


@dataclass
class Node:
    rows: np.ndarray  # of a leaf
    point: int = -1
    median: float = 0.0
    near: "Node | None" = None
    far: "Node | None" = None


def build(x: np.ndarray, rows: np.ndarray | None = None, depth: int = 0) -> Node:
    """The tree over x's rows. Where all distances to the vantage point tie (copies), the node stays a leaf."""
    rows = np.arange(len(x)) if rows is None else rows
    if len(rows) <= LEAF:
        return Node(rows)
    point = int(rows[(depth * 7919) % len(rows)])
    d = np.sqrt(((x[rows] - x[point]) ** 2).sum(axis=1))
    median = float(np.median(d))
    inner = d < median
    if not inner.any():
        inner = d <= median
        median = float(np.nextafter(median, np.inf))
    if inner.all():
        return Node(rows)
    return Node(rows[:0], point, median, build(x, rows[inner], depth + 1), build(x, rows[~inner], depth + 2))


class Search:
    """The k nearest of x's rows for a batch of queries; own: the id that a query must not find."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int, factor: float, bound: np.ndarray | None = None) -> None:
        self.x, self.ids, self.q, self.own, self.k, self.factor = x, ids, queries, own, k, factor
        self.norms = (x * x).sum(axis=1)
        self.dist = np.full((len(queries), k), np.inf)
        self.bound = np.full(len(queries), np.inf) if bound is None else bound
        self.found = np.full((len(queries), k), np.iinfo(np.int64).max)
        self.compared = 0

    def run(self, root: Node) -> None:
        if len(self.q):
            self.visit(root, np.arange(len(self.q)))

    def limit(self, active: np.ndarray) -> np.ndarray:
        """What a neighbour must not be farther than: the k-th best of this tree, or of others before it."""
        return np.minimum(self.dist[active, -1], self.bound[active])

    def offer(self, active: np.ndarray, rows: np.ndarray) -> None:
        """Compare, first by the fast expansion with a margin for its rounding, then exactly what may enter the lists."""
        self.compared += len(active) * len(rows)
        for part in np.array_split(rows, max(1, -(-len(rows) // 2048))):
            q = self.q[active]
            rough = (q * q).sum(axis=1)[:, None] + self.norms[part] - 2 * (q @ self.x[part].T)
            limit = self.limit(active) ** 2
            a, b = np.nonzero(rough <= (limit * (1 + 1e-9) + 1e-9 * (1 + self.norms[part].max(initial=0)))[:, None])
            keep = self.ids[part[b]] != self.own[active[a]]
            a, b = a[keep], b[keep]
            if not len(a):
                continue
            d = np.sqrt(((q[a] - self.x[part[b]]) ** 2).sum(axis=1))
            who = active[np.unique(a)]
            qs = np.r_[active[a], np.repeat(who, self.k)]
            ds = np.r_[d, self.dist[who].ravel()]
            vs = np.r_[self.ids[part[b]], self.found[who].ravel()]
            order = np.lexsort((vs, ds, qs))
            qs, ds, vs = qs[order], ds[order], vs[order]
            rank = np.arange(len(qs)) - np.searchsorted(qs, qs, side="left")
            top = rank < self.k
            self.dist[qs[top], rank[top]], self.found[qs[top], rank[top]] = ds[top], vs[top]

    def visit(self, node: Node, active: np.ndarray) -> None:
        if node.near is None:
            self.offer(active, node.rows)
            return
        d = np.sqrt(((self.q[active] - self.x[node.point]) ** 2).sum(axis=1))
        inner = d < node.median
        gap = np.abs(d - node.median)
        for side, other, own in ((node.near, node.far, inner), (node.far, node.near, ~inner)):
            if own.any():
                self.visit(side, active[own])
                reach = own & (gap <= self.factor * self.limit(active))
                if reach.any():
                    self.visit(other, active[reach])


@dataclass
class Split:
    """A node of the top that cells come from; a cell is its number."""

    point: np.ndarray
    median: float
    near: "Split | int"
    far: "Split | int"


def grow(x: np.ndarray, cells: int, first: int = 0, depth: int = 0) -> tuple["Split | int", int]:
    """The top of a tree over x with so many cells at most, numbered from first, and the number behind the last."""
    if cells < 2 or len(x) < 2:
        return first, first + 1
    point = x[(depth * 7919) % len(x)]
    d = np.sqrt(((x - point) ** 2).sum(axis=1))
    median = float(np.median(d))
    inner = d < median
    if not inner.any():
        return first, first + 1
    near, then = grow(x[inner], cells // 2, first, depth + 1)
    far, end = grow(x[~inner], cells - cells // 2, then, depth + 2)
    return Split(point, median, near, far), end


def reached(top: Split | int, x: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of x, cell): each row's own cell, and the cells that a bound (already times the factor) reaches."""
    if not isinstance(top, Split):
        return np.arange(len(x)), np.full(len(x), top, np.int32)
    d = np.sqrt(((x - top.point) ** 2).sum(axis=1))
    rows, cells = [], []
    for side, own in ((top.near, d < top.median), (top.far, d >= top.median)):
        go = np.flatnonzero(own | (np.abs(d - top.median) <= bound))
        if len(go):
            r, c = reached(side, x[go], bound[go])
            rows.append(go[r])
            cells.append(c)
    return np.concatenate(rows), np.concatenate(cells)


def usable(v: str) -> F.Column:
    """Neither null nor zero, without null, NaN or infinite components."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(v).isNotNull() & ~bad & F.exists(v, lambda x: x != 0)


def nearest(vectors: DataFrame, queries: DataFrame, key: str, vector: str, k: int = 10, factor: float = FACTOR) -> DataFrame:
    """query_id, query_hash, rank (from 1), key, score: each query's k nearest vectors of the same length, other keys only.

    score is the Euclidean distance in double precision; ties go to the smaller key. Unusable vectors (see usable) and
    rows without a key take no part, repeated rows are found once each, other columns are ignored, an empty table gives
    an empty result. Different vectors of one key are found each, and as queries have a list each (query_hash, a hash of the
    vector, tells them apart). Every row is indexed, its shard's tree is built once and stored; a shard is of bounded size whatever its cell holds, since copies of one vector
    are spread over a cell's shards by their keys, and a node whose distances all tie is scanned as a leaf.
    """
    def clean(df: DataFrame) -> DataFrame:
        return df.filter(F.col(quoted(key)).isNotNull()).select(F.col(quoted(key)).cast("long").alias("id"), F.col(quoted(vector)).alias("v")).filter(usable("v")).withColumns({"dim": F.size("v"), "h": F.xxhash64("v")})

    base, asked = clean(vectors), clean(queries)
    n, m = base.count(), asked.count()
    size = min(MOST, max(LEAST, n // 64))
    blocks = max(1, -(-m // BLOCK))
    tops = _tops(base, n, min(CELLS, -(-n // size)))
    kind = base.schema["v"].dataType.simpleString()

    def located(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows (id, v, dim, h, bound) with the other cells that bound reaches; without a bound, with their own."""
        for pdf in it:
            for dim, part in pdf.groupby("dim", sort=False):
                top, x = tops.get(dim, 0), np.stack(part.v.to_numpy()).astype(np.float64)
                rows, cells = reached(top, x, np.full(len(x), -1.0))
                if part.bound.notna().all():
                    home = np.empty(len(x), np.int32)
                    home[rows] = cells
                    rows, cells = reached(top, x, part.bound.to_numpy(np.float64) * factor)
                    rows, cells = rows[cells != home[rows]], cells[cells != home[rows]]
                yield part.iloc[rows].assign(cell=cells)

    def cells_of(df: DataFrame, bound: Column) -> DataFrame:
        return df.select("id", "v", "dim", "h", bound.cast("double").alias("bound")).mapInPandas(located, f"id bigint, v {kind}, dim int, h bigint, bound double, cell int")

    block = F.pmod(F.xxhash64(F.lit(1), "id", "h"), F.lit(blocks)).cast("int")
    own = cut(cells_of(base, F.lit(None)).drop("bound"), "cells")
    sizes = cut(own.groupBy("dim", "cell").agg(F.ceil(F.count("*") / size).cast("int").alias("shards")), "sizes")
    dealt = own.join(sizes, ["dim", "cell"]).withColumn("shard", F.pmod(F.xxhash64("id", "h"), F.col("shards")).cast("int")).select("id", "v", "dim", "cell", "shard")

    def store(pdf: pd.DataFrame) -> pd.DataFrame:
        """A shard in one row: its ids, vectors and tree."""
        pdf = pdf.sort_values("id", ignore_index=True)
        x = np.stack(pdf.v.to_numpy())
        said = pickle.dumps((pdf.id.to_numpy(np.int64), x, build(x.astype(np.float64))))
        return pd.DataFrame({**{c: [pdf[c].iloc[0]] for c in ("dim", "cell", "shard")}, "tree": [said]})

    trees = cut(dealt.groupBy("dim", "cell", "shard").applyInPandas(store, "dim int, cell int, shard int, tree binary"), "trees")

    def cell(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "query_hash": [], "id": [], "score": []}).astype({"query_id": "int64", "query_hash": "int64", "id": "int64", "score": "float64"})
        ids, x, tree = pickle.loads(left.tree.iloc[0])
        right = right.sort_values(["id", "h"], ignore_index=True)
        q, bound = np.stack(right.v.to_numpy()).astype(np.float64), right.bound.to_numpy(np.float64)
        search = Search(x.astype(np.float64), ids, q, right.id.to_numpy(np.int64), k, factor, np.where(np.isnan(bound), np.inf, bound))
        search.run(tree)
        hit = np.isfinite(search.dist)
        told = {c: np.repeat(right[n].to_numpy(np.int64), k).reshape(hit.shape)[hit] for c, n in (("query_id", "id"), ("query_hash", "h"))}
        return pd.DataFrame({**told, "id": search.found[hit], "score": search.dist[hit]})

    def search(calls: DataFrame) -> DataFrame:
        """Neighbours in the cells of calls (id, v, dim, h, bound, cell). A tree goes to the blocks of queries that call its cell."""
        calls = cut(calls.withColumn("block", block), "calls")
        wanted = trees.join(calls.select("dim", "cell", "block").distinct(), ["dim", "cell"])
        wanted = wanted.toDF(*wanted.columns)
        asking = calls.join(sizes, ["dim", "cell"]).withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).drop("shards")
        by = ("dim", "cell", "shard", "block")
        return wanted.groupBy(*by).cogroup(asking.groupBy(*by)).applyInPandas(cell, "query_id bigint, query_hash bigint, id bigint, score double")

    def best(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id", "query_hash").orderBy("score", "id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    # repeated queries are asked once
    asked = cut(asked.dropDuplicates(["id", "v"]), "asked")
    found = cut(best(search(cells_of(asked, F.lit(None)))), "found")
    if any(isinstance(t, Split) for t in tops.values()):
        bounds = found.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("query_hash").alias("h"), F.col("score").alias("bound"))
        # a query whose own cell has too few neighbours goes everywhere
        wider = asked.join(bounds, ["id", "h"], "left").withColumn("bound", F.coalesce("bound", F.lit(EVERYWHERE)))
        found = best(found.drop("rank").unionByName(search(cells_of(wider, F.col("bound")))))
    return found.select("query_id", "query_hash", F.col("rank").cast("int").alias("rank"), F.col("id").alias(key), "score")


def _tops(base: DataFrame, n: int, cells: int) -> dict[int, Split | int]:
    """For each length of vectors in a sample the top of a tree; lengths that are not in it have one cell."""
    if cells < 2:
        return {}
    chosen = F.pmod(F.xxhash64("h", "id"), F.lit(max(1, n // SAMPLE))) == 0
    sample = base.filter(chosen).limit(2 * SAMPLE).select("dim", "v").toPandas()
    return {int(dim): grow(np.stack(part.v.to_numpy()).astype(np.float64), cells)[0] for dim, part in sample.groupby("dim")}


def op4_vantage_point_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter(F.col("vec_id") % 100 == 0), "vec_id", "embedding").select("query_id", "rank", "vec_id", "score")
