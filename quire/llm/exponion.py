"""Compression of vectors to short codes: a codebook for each part of a vector, learned by exact rounds of assignment and averaging.

Assignment is an exponion search. A part starts at the entry that it had before, at distance u. An entry nearer than the best
distance b so far is within u + b of that start, so only the start's neighbours within this radius are compared, in the order of
their distance from it; the radius shrinks as b does. All distances are squares of integers, computed exactly, and ties go to
the smaller index. Every round reads the table once and writes it with its new codes, beside sums for each task.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from quire.llm.common import cut, discard, quoted, scratch, table
from quire.llm.products import usable, whole

#: Neighbours that are compared at a time, and components that a task holds at once.
STEP, COMPONENTS = 32, 2**22


def _root(x: np.ndarray) -> np.ndarray:
    """An integer not below the square root of each integer, and at most 2 above it."""
    return np.sqrt(x.astype(np.float64)).astype(np.int64) + 1


@dataclass
class Book:
    """The entries of one part, and for each entry all entries by their distance from it (ties by index)."""

    entries: np.ndarray

    def __post_init__(self) -> None:
        e = self.entries
        square = (e * e).sum(axis=1)
        apart = square[:, None] + square[None, :] - 2 * (e @ e.T)
        self.order = np.argsort(apart, axis=1, kind="stable")
        self.apart = np.take_along_axis(apart, self.order, axis=1)

    def nearest(self, x: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each row of integers, from its entry in start."""
        largest = x.shape[1] * (2 * max(int(np.abs(x).max(initial=0)), int(np.abs(self.entries).max(initial=0)), 1)) ** 2
        if largest >= 2**62:
            raise ValueError("components too large: a squared distance may not fit into 64 bits")
        kind = np.float64 if largest < 2**53 else np.int64  # the first is exact below 2**53, and faster
        rows, entries = x.astype(kind), self.entries.astype(kind)
        square, mine = (entries * entries).sum(axis=1), (rows * rows).sum(axis=1)
        best = ((x - self.entries[start]) ** 2).sum(axis=1)
        found = start.astype(np.int64)
        by = np.argsort(start, kind="stable")
        for group in np.split(by, np.flatnonzero(np.diff(start[by])) + 1) if len(by) else []:
            a = int(start[group[0]])
            apart, first = self.apart[a], best[group]
            reach = np.searchsorted(apart, 4 * first, side="right")
            for at in range(0, len(entries), STEP):
                active = np.flatnonzero(reach > at)
                if not len(active):
                    break
                near = np.sort(self.order[a, at : at + STEP])  # by index: the first of equal distances is the smallest
                who = group[active]
                d = mine[who][:, None] - 2 * (rows[who] @ entries[near].T) + square[near][None, :]
                j = d.argmin(axis=1)
                d, e = d[np.arange(len(who)), j].astype(np.int64), near[j]
                better = (d < best[who]) | (d == best[who]) & (e < found[who])
                best[who[better]], found[who[better]] = d[better], e[better]
                radius = _root(first[active]) + _root(best[who])
                reach[active] = np.minimum(reach[active], np.searchsorted(apart, radius * radius, side="right"))
        return found, best


@dataclass
class Codes:
    """rows: row_ (the rest of a row), x (its integers), code (an entry a part) and error; books: the entries of each part."""

    rows: DataFrame
    books: list[np.ndarray]

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(v) for b in self.books for v in b.ravel().tolist()).encode()).hexdigest()


def _rounds(books: list[np.ndarray] | None, dim: int, sums: bool):  # noqa: ANN202
    """A pass over rows: their nearest entries from those they had, and, with sums, rows that add up what each entry got."""
    tables = [Book(b) for b in books]
    width = dim // len(books)

    def done(batches: list[pa.RecordBatch], total: dict) -> pa.RecordBatch:
        rows = pa.Table.from_batches(batches).combine_chunks()
        n = len(rows)
        x = rows.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, dim)
        code = rows.column("code").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, len(books))
        error = np.zeros(n, np.int64)
        new = np.empty_like(code)
        for p, book in enumerate(tables):
            part = np.ascontiguousarray(x[:, p * width : (p + 1) * width])
            new[:, p], d = book.nearest(part, code[:, p])
            error += d
            if sums:
                by = np.argsort(new[:, p], kind="stable")
                entry, first = np.unique(new[by, p], return_index=True)
                total["sum"][p, entry] += np.add.reduceat(part[by], first, axis=0)
                total["n"][p, entry] += np.diff(np.r_[first, n])
        lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * len(books), pa.int32()), pa.array(new.ravel(), pa.int64()), type=rows.schema.field("code").type)
        kept = [rows.column(c).combine_chunks() for c in ("row_", "x")]
        nothing = [pa.nulls(n, t) for t in (pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.int64())]
        return pa.RecordBatch.from_arrays([*kept, lists, pa.array(error), *nothing], names=["row_", "x", "code", "error", "part", "entry", "added", "number"])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {"sum": np.zeros((len(books), len(books[0]), width), np.int64), "n": np.zeros((len(books), len(books[0])), np.int64)}
        held: list[pa.RecordBatch] = []
        kinds = None
        for batch in it:
            kinds = batch.schema
            held.append(batch)
            if sum(len(b) for b in held) * max(1, dim) >= COMPONENTS:
                yield done(held, total)
                held = []
        if any(len(b) for b in held):
            yield done(held, total)
        part, entry = np.nonzero(total["n"])
        if len(part):
            m = len(part)
            added = pa.ListArray.from_arrays(pa.array(np.arange(m + 1) * width, pa.int32()), pa.array(total["sum"][part, entry].ravel(), pa.int64()))
            empty = [pa.nulls(m, kinds.field(c).type) for c in ("row_", "x", "code")]
            numbers = [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), added, pa.array(total["n"][part, entry], pa.int64())]
            yield pa.RecordBatch.from_arrays([*empty, pa.nulls(m, pa.int64()), *numbers], names=["row_", "x", "code", "error", "part", "entry", "added", "number"])

    return run


def learn(vectors: DataFrame, key: str, vector: str, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> Codes:
    """Codes of the integers floor(scale * component).

    The codebooks start as the parts of the vectors of the smallest keys, ascending; each round assigns every part to the nearest
    entry and replaces an entry by the floored mean of its parts, unused ones stay; then parts are assigned again. Vectors null or
    with null or non-finite components take no part, nor do those of another length than the vector of the smallest key; a length
    that the parts don't divide raises an error. A row without a key gets a code and is no start; of several vectors of one key the
    smallest is the start. Repeated rows count each. Other columns are kept whatever their names; no row gives empty codebooks."""
    spark = vectors.sparkSession
    # a struct keeps all columns apart from those made here, whatever their names
    whole_row = F.struct(*(F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(vectors.columns) if c != vector))
    rows = vectors.select(F.col(quoted(key)).cast("long").alias("id_"), whole_row.alias("row_"), F.col(quoted(vector)).alias("v_")).filter(usable("v_"))
    rows = cut(rows.select("id_", "row_", whole("v_", scale).alias("x")).withColumn("dim_", F.size("x")), "whole")
    least = rows.filter("id_ IS NOT NULL").agg(F.min(F.struct("id_", "dim_")).alias("least")).first().least
    if least is None:
        none = StructType([*rows.select("row_", "x").schema.fields, StructField("code", ArrayType(LongType())), StructField("error", LongType())])
        return Codes(spark.createDataFrame([], none), [np.empty((0, 0), np.int64)] * parts)
    dim = least.dim_
    if dim % parts:
        raise ValueError(f"vectors of {dim} components can't be cut into {parts} equal parts")
    source, rows = rows, rows.filter(F.col("dim_") == dim)
    # first the keys alone, so that a task sends a few numbers; then their vectors, of which repeated keys keep one
    keys = [r.id_ for r in rows.filter("id_ IS NOT NULL").select("id_").distinct().orderBy("id_").limit(entries).collect()]
    first = rows.filter(F.col("id_").between(keys[0], keys[-1])).groupBy("id_").agg(F.min("x").alias("x")).orderBy("id_").collect()
    start = np.array([r.x for r in first], np.int64).reshape(len(first), dim)
    books = [np.ascontiguousarray(start[:, p * dim // parts : (p + 1) * dim // parts]) for p in range(parts)]
    state = rows.select("row_", "x", F.array(*[F.lit(0).cast("long")] * parts).alias("code"))
    state._quire_path = source._quire_path
    more = "error long, part int, entry int, added array<long>, number long"
    schema = StructType([*state.schema.fields, *StructType.fromDDL(more).fields])
    for f in schema.fields:
        f.nullable = True
    for turn in range(rounds + 1):
        after = cut(state.mapInArrow(_rounds(books, dim, turn < rounds), schema), "codes")
        discard(state)
        state = after.filter("part IS NULL").select("row_", "x", "code", "error")
        state._quire_path = after._quire_path
        if turn < rounds:
            books = _means(after, books)
            state = state.drop("error")
            state._quire_path = after._quire_path
    return Codes(state, books)


def _means(after: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The entries after a round; what comes to the driver is of the size of the codebooks."""
    sums = after.filter("part IS NOT NULL").select("part", "entry", "number", "added")
    # a length of 0 has no component to add, and nothing to change
    each = sums.select("part", "entry", "number", F.posexplode("added").alias("at", "v")).groupBy("part", "entry", "at").agg(F.sum("v").alias("v"), F.sum("number").alias("n"))
    books = [b.copy() for b in books]
    for r in each.collect():
        books[r.part][r.entry, r["at"]] = r.v // r.n
    return books


def decode(codes: Codes, scale: int = 1024) -> DataFrame:
    """row_ and vector: the vectors that the codes stand for."""
    books = [b.astype(np.float64) / scale for b in codes.books]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            code = batch.column("code").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), len(books))
            x = np.concatenate([b[code[:, p]] for p, b in enumerate(books)], axis=1) if len(batch) else np.empty((0, 0))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel(), pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("row_"), lists], names=["row_", "vector"])

    rows = codes.rows.select("row_", "code")
    return rows.mapInArrow(run, StructType([rows.schema["row_"], StructField("vector", ArrayType(StructType.fromDDL("x double")["x"].dataType))]))


def code_digest(vectors: DataFrame, key: str, vector: str, label: str, **how: int) -> DataFrame:
    """key, code (two hex digits a part; how: see learn(), entries at most 256), error, label_error (error summed over equal labels,
    nulls together) and codebooks_sha256."""
    with scratch() as keep:
        codes = learn(vectors.select(F.col(quoted(key)).alias(key), F.col(quoted(label)).alias(label), F.col(quoted(vector)).alias("v_")), key, "v_", **how)
        rows = codes.rows.select(F.col("row_.c0").alias("id_"), F.col("row_.c1").alias("label_"), "code", "error")
        sums = cut(rows.groupBy("label_").agg(F.sum("error").alias("label_error")), "labels").withColumnRenamed("label_", "other_")
        hexed = F.array_join(F.transform("code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
        out = rows.join(sums, F.col("label_").eqNullSafe(F.col("other_")))
        out = out.select(F.col("id_").alias(key), hexed.alias("code"), "error", "label_error", F.lit(codes.digest()).alias("codebooks_sha256"))
        return keep(cut(out, "coded"))


def op12_exponion_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_digest(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
