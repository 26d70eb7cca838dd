"""SimHash near-dedup by anchor-point covering.

The anchors are the words of the perfect Hamming code on 63 of the 64 bits: every fingerprint has exactly one anchor within
the covering radius 1. Two fingerprints that differ in 2 bits or fewer have a point within 1 of both (half the
threshold), and that point's anchor is within 1 of it, hence within 2 of both. So each fingerprint is replicated to
every anchor within covering radius plus half the threshold: 32 of 2**57 anchors, or itself if it is an anchor. What meets
at an anchor is compared on all 64 bits. A whole threshold on one side would find the same pairs with 652 replicas.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import columns, cut, fresh, quoted, scratch, small_batches, table
from quire.llm.components import components

SEED, BITS = 42, 2
_LOW = np.uint64((1 << 63) - 1)
#: Groups up to this size are compared pair by pair; larger ones (4034 at most) are linked through shared bits.
PAIRWISE = 24
#: Hashes whose bits are counted together.
CHUNK = 65536
#: Classes of shingles whose parities a set keeps, and rows of one shingle that a task compares with each other.
PARITIES, BLOCK = 1024, 8192
#: Shingles that a part of them holds on average at most (16 MB), and the powers of two that the number of parts is between.
PART, FEWEST, MANY = 2**21, 12, 20


def shingles(text: str | None, size: int) -> np.ndarray:
    """The XXH64 of a text's word shingles, repeats included; a text of fewer words is one shingle, a wordless one has none."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    found = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False)) if len(words) >= size else [b" ".join(words)]
    return np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), found), np.uint64)


def majority(h: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    if not len(h):
        return 0
    ones = np.zeros(64, np.int64)
    for part in np.array_split(h, max(1, len(h) // CHUNK)):
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, size: int) -> int:
    """The SimHash of a text's word shingles, repeats included: a bit is set if it is set in over half of their XXH64."""
    return majority(shingles(text, size))


def fingerprints(docs: DataFrame, key: str, text: str, size: int = 3) -> DataFrame:
    """(key, fp) for every row; fp is the fingerprint as a signed long. Null and wordless texts have fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.fromiter((fingerprint(x.as_py(), size) for x in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], ["key", "fp"])

    small_batches(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).alias("text")).mapInArrow(run, f"key {kind}, fp bigint").withColumnRenamed("key", key)


def _pair_masks() -> np.ndarray:
    """For each syndrome s > 0 the 31 masks of two of the 63 bits whose numbers have the exclusive or s."""
    masks = np.zeros((64, 31), np.uint64)
    for s in range(1, 64):
        masks[s] = [1 << (i - 1) | 1 << ((i ^ s) - 1) for i in range(1, 64) if i < i ^ s and i != s]
    return masks


_PAIRS = _pair_masks()
_CHECKS = [np.uint64(sum(1 << (i - 1) for i in range(1, 64) if i >> b & 1)) for b in range(6)]


def anchors(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All anchors within distance 2 of the fingerprints' 63 bits: (row of fp, anchor)."""
    x = fp.astype(np.uint64) & _LOW
    syndrome = np.zeros(len(x), np.int64)
    for b, mask in enumerate(_CHECKS):
        syndrome |= (np.bitwise_count(x & mask).astype(np.int64) & 1) << b
    exact, other = np.flatnonzero(syndrome == 0), np.flatnonzero(syndrome)
    s = syndrome[other]
    home = x[other] ^ (np.uint64(1) << (s - 1).astype(np.uint64))
    far = x[other][:, None] ^ _PAIRS[s]
    return np.r_[exact, other, np.repeat(other, 31)], np.r_[x[exact], home, far.ravel()]


def _linked(anchor: int, fps: list[int]) -> Iterator[tuple[int, int]]:
    """Links that connect whatever is within BITS bits among the distinct fingerprints at an anchor, no more than a few for each.

    Their 63 bits differ from the anchor's in a set of at most two bits. Those with a common bit and the same top bit are
    within 2 of each other, so a star joins them; so do the empty set and every other with its top bit. With unlike top
    bits one difference is left: equal sets, or sets of which one has a bit less.
    """
    low = (1 << 63) - 1
    stars: dict[tuple[int, int], int] = {}
    single: dict[tuple[int, int], int] = {}
    empty: dict[int, int] = {}
    sets = []
    for x in fps:
        e, top = (x ^ anchor) & low, x >> 63
        bits = []
        while e:
            bits.append(e & -e)
            e &= e - 1
        sets.append((x, top, bits))
        if not bits:
            empty[top] = x
        elif len(bits) == 1:
            single[top, bits[0]] = x
    twins: dict[tuple[int, ...], int] = {}
    for x, top, bits in sets:
        for b in bits:
            first = stars.setdefault((top, b), x)
            if first != x:
                yield first, x
            other = single.get((1 - top, b))
            if other is not None:
                yield other, x
        if bits and top in empty:
            yield empty[top], x
        if len(bits) < 2 and 1 - top in empty and empty[1 - top] != x:
            yield empty[1 - top], x
        twin = twins.setdefault(tuple(bits), x)
        if twin != x:
            yield twin, x


def _meet(anchor: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows sorted by (anchor, fp), repeats of a row removed."""
    fresh = np.r_[True, (anchor[1:] != anchor[:-1]) | (fp[1:] != fp[:-1])]
    anchor, fp = anchor[fresh], fp[fresh]
    heads = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    sizes = np.diff(np.r_[heads, len(anchor)])
    left, right = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
    large = np.repeat(sizes > PAIRWISE, sizes)
    for step in range(1, min(PAIRWISE, int(sizes.max(initial=0)))):
        i = np.flatnonzero((anchor[step:] == anchor[:-step]) & ~large[step:])
        i = i[np.bitwise_count(fp[i] ^ fp[i + step]) <= BITS]
        left.append(fp[i])
        right.append(fp[i + step])
    for h, n in zip(heads[sizes > PAIRWISE], sizes[sizes > PAIRWISE], strict=True):
        pairs = np.array([*_linked(int(anchor[h]), fp[h : h + n].tolist())], np.uint64).reshape(-1, 2)
        left.append(pairs[:, 0])
        right.append(pairs[:, 1])
    return np.concatenate(left), np.concatenate(right)


def links(fps: DataFrame) -> DataFrame:
    """Distinct links (x, y) between distinct fingerprints (column fp) that connect all those within BITS bits."""

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            rows, anchor = anchors(fp)
            yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(fp[rows].view(np.int64))], ["anchor", "fp"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.empty((2, 0), np.uint64)

        def linked(rows: np.ndarray) -> pa.RecordBatch:
            x, y = _meet(*rows)
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], ["x", "y"])

        for batch in batches:
            rows = np.concatenate([rest, np.stack([c.to_numpy(zero_copy_only=False).view(np.uint64) for c in batch.columns])], axis=1)
            whole = int(np.flatnonzero(rows[0] != rows[0, -1])[-1]) + 1 if rows.size and (rows[0] != rows[0, -1]).any() else 0
            if whole:
                yield linked(rows[:, :whole])
            rest = rows[:, whole:]
        if rest.size:
            yield linked(rest)

    met = fps.select("fp").mapInArrow(replicate, "anchor bigint, fp bigint").repartition("anchor").sortWithinPartitions("anchor", "fp")
    return met.mapInArrow(compare, "x bigint, y bigint").distinct()


def near_duplicates(docs: DataFrame, key: str, text: str, size: int = 3) -> DataFrame:
    """(key, fp, component) for every row; component is the smallest key that its fingerprint reaches over links of at most BITS bits.

    Copies share a fingerprint and are folded into one before anything is compared, so a group of copies costs one row.
    Fingerprints at an anchor number 4034 at most, by the code's geometry. Wordless and null texts form one group. Rows
    with a null key take part; a group with no other key has a null component. Other columns are ignored.
    """
    with scratch() as keep:
        fps = keep(cut(fingerprints(docs, key, text, size), "fingerprints"))
        firsts = cut(fps.groupBy("fp").agg(F.min(quoted(key)).alias("first")), "firsts")
        roots = components(links(firsts)).withColumnRenamed("node", "fp")
        linked = cut(roots.join(firsts, "fp"), "linked")
        best = cut(linked.groupBy("root").agg(F.min("first").alias("component")), "best")
        named = linked.join(best, "root").select("fp", "component")
        classes = keep(cut(firsts.join(named, "fp", "left").select("fp", F.coalesce("component", "first").alias("component")), "classes"))
    return fps.join(classes, "fp").select(quoted(key), "fp", "component")


# Near copies further apart ------------------------------------------------------------------------------------------
#
# At a similarity of 0.8 about a seventh of a fingerprint's bits differ, too many for its anchors. So the stage takes what
# the anchors find first, checks it on the sets of shingles, and completes it by an exact join of these sets: see _shared.


def shingle_set(text: str | None, size: int) -> tuple[np.ndarray, int]:
    """The sorted distinct XXH64 of a text's word shingles, without their lowest four bits, and the SimHash of the distinct ones."""
    found = np.unique(shingles(text, size))
    short = found >> np.uint64(4)
    return short[np.r_[True, short[1:] != short[:-1]]] if len(short) else short, majority(found)


def _digest(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


def _least(n: np.ndarray, similarity: float) -> np.ndarray:
    """The least number of common shingles of a set of n with any set as similar."""
    return np.ceil(similarity * n - 1e-9).astype(np.int64)


def _parities(found: np.ndarray) -> bytes:
    """Whether the number of shingles of a set is odd, for each of PARITIES classes of shingles, packed."""
    return np.packbits(np.bincount((found % np.uint64(PARITIES)).astype(np.int64), minlength=PARITIES).astype(np.uint8) & 1).tobytes()


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Rows sorted by their first column, as the whole rows of one or several of its values at a time."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        first = batch.column(0).to_numpy(zero_copy_only=False)
        start = int(np.searchsorted(first, first[-1], side="left"))
        if start or rest and rest[0].column(0)[0].as_py() != first[0]:
            whole = [*rest, batch.slice(0, start)] if start else rest
            yield whole
            rest = []
        rest.append(batch.slice(start))
    if rest:
        yield rest


_ENTRY = np.dtype([("at", "<u2"), ("df", "<u4"), ("shingle", "<u8")])
_LOW48 = np.uint64((1 << 48) - 1)


def _shared(texts: DataFrame, size: int, similarity: float, bits: int) -> DataFrame:
    """(node, n, shared, prefix, parity) of texts (doc, digest, text) that may have a partner: the number of distinct shingles,
    those that other texts have too (sorted, packed), those of them in the prefix, and the parities of all of them.

    Shingles are ordered by the number of texts they are in, then by hash. Two sets of the similarity have a common shingle
    among the first n - least + 1 of either, so a text whose prefix is all its own has no partner. Shingles go by the first
    `bits` of 60 bits to where they are counted, packed by batch of texts, and those in two texts or more come back to their batch."""
    below, spare = np.uint64(60 - bits), np.uint64(bits - 12)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        parts = np.arange(1, 1 << bits, dtype=np.uint64) << below
        for batch in batches:
            sets, nodes = [], []
            for doc, digest, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found, _ = shingle_set(text, size)
                if len(found) and _digest(found) == digest:
                    sets.append(found)
                    nodes.append(doc)
            if not sets:
                continue
            n = np.array([len(x) for x in sets])
            h, at = np.concatenate(sets), np.repeat(np.arange(len(sets), dtype=np.uint64), n)
            order = np.argsort(h)
            h, packed = h[order], ((h & _LOW48) << np.uint64(16) | at)[order]
            ends = np.r_[0, np.searchsorted(h, parts), len(h)]
            full = np.flatnonzero(ends[1:] > ends[:-1])
            blobs = [np.stack([np.array(nodes, np.int64), n]).tobytes(), *(packed[ends[p] : ends[p + 1]].tobytes() for p in full.tolist())]
            part = np.r_[task // 2**32 * 61 % (1 << bits), full].astype(np.int32)
            names = np.full(len(part), task, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(names), pa.array(np.arange(len(part)) > 0), pa.array(blobs, pa.binary())], ["part", "batch", "entry", "blob"])
            task += 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            part, name, entry = (np.concatenate([r.column(i).to_numpy(zero_copy_only=False) for r in rows]) for i in range(3))
            blobs = [x for r in rows for x in r.column(3).to_pylist()]
            heads = np.flatnonzero(~entry.astype(bool))
            yield pa.RecordBatch.from_arrays([pa.array(name[heads]), pa.array(np.zeros(len(heads), bool)), pa.array([blobs[i] for i in heads.tolist()], pa.binary())], ["batch", "entry", "blob"])
            out_names, out = [], []
            for p in np.unique(part).tolist():
                mine = np.flatnonzero(entry.astype(bool) & (part == p))
                if not len(mine):
                    continue
                packed = np.frombuffer(b"".join(blobs[i] for i in mine.tolist()), "<u8")
                of = np.repeat(name[mine], [len(blobs[i]) // 8 for i in mine.tolist()])
                order = np.argsort(packed >> np.uint64(16), kind="stable")
                h = (packed >> np.uint64(16))[order]
                starts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
                df = np.diff(np.r_[starts, len(h)])
                df = np.repeat(df, df)
                keep = df > 1
                if not keep.any():
                    continue
                entries = np.empty(int(keep.sum()), _ENTRY)
                picked = order[keep]
                entries["at"], entries["df"], entries["shingle"] = packed[picked] & np.uint64(65535), df[keep], h[keep] | np.uint64(p) >> spare << np.uint64(48)
                of = of[picked]
                order = np.argsort(of, kind="stable")
                entries, of = entries[order], of[order]
                cuts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
                out_names += of[cuts].tolist()
                out += [entries[a:b].tobytes() for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(of)], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(out_names, pa.int64()), pa.array([True] * len(out), pa.bool_()), pa.array(out, pa.binary())], ["batch", "entry", "blob"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            name, entry = (np.concatenate([r.column(i).to_numpy(zero_copy_only=False) for r in rows]) for i in range(2))
            blobs = [x for r in rows for x in r.column(2).to_pylist()]
            for b in np.unique(name).tolist():
                mine = np.flatnonzero(name == b)
                head = next(i for i in mine.tolist() if not entry[i])
                nodes, n = np.frombuffer(blobs[head], np.int64).reshape(2, -1)
                entries = np.frombuffer(b"".join(blobs[i] for i in mine.tolist() if entry[i]), _ENTRY)
                entries = entries[np.lexsort((entries["shingle"], entries["df"], entries["at"]))]
                has = np.bincount(entries["at"], minlength=len(nodes))
                first = np.r_[0, np.cumsum(has)]
                ours = np.minimum(n - _least(n, similarity) + 1 - (n - has), has)
                hit = np.flatnonzero(ours > 0).tolist()
                lists = [entries["shingle"][first[i] : first[i + 1]] for i in hit]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(nodes[hit]),
                        pa.array(n[hit]),
                        pa.array([np.sort(x).tobytes() for x in lists], pa.binary()),
                        pa.array([x[: ours[i]].view(np.int64) for i, x in zip(hit, lists, strict=True)], pa.list_(pa.int64())),
                        pa.array([_parities(x) for x in lists], pa.binary()),
                    ],
                    ["node", "n", "shared", "prefix", "parity"],
                )

    dealt = texts.select("doc", "digest", "text").mapInArrow(deal, "part int, batch long, entry boolean, blob binary").repartition("part").sortWithinPartitions("part")
    counted = dealt.mapInArrow(count, "batch long, entry boolean, blob binary").repartition("batch").sortWithinPartitions("batch")
    return cut(counted.mapInArrow(gather, "node long, n long, shared binary, prefix array<long>, parity binary"), "shared")


def _pairs(cell: np.ndarray, node: np.ndarray, n: np.ndarray, private: np.ndarray, root: np.ndarray, side: np.ndarray, parity: np.ndarray, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of nodes in one cell (rows sorted by cell), of unlike roots and unlike sides (side 0 meets itself too) that may have the
    similarity: by their sizes, and by how many shingles at least are in one set only. Classes of unlike parity hold one such
    shingle each, and the private ones (of one text alone) are known, so no pair of the similarity is lost."""

    def fit(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ok = (root[i] != root[j]) & ((side[i] != side[j]) | (side[i] == 0)) & (_least(np.maximum(n[i], n[j]), similarity) <= np.minimum(n[i], n[j]))
        i, j = i[ok], j[ok]
        apart = private[i] + private[j] + np.bitwise_count(parity[i] ^ parity[j]).sum(axis=1, dtype=np.int64)
        ok = apart <= (1 - similarity) / (1 + similarity) * (n[i] + n[j]) + 1e-6
        x, y = np.minimum(node[i], node[j])[ok], np.maximum(node[i], node[j])[ok]
        order = np.lexsort((y, x))
        x, y = x[order], y[order]
        fresh = np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])] if len(x) else np.empty(0, bool)
        return x[fresh], y[fresh]

    heads = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    sizes = np.diff(np.r_[heads, len(cell)])
    small = np.repeat(sizes <= 64, sizes)
    for step in range(1, min(64, int(sizes.max(initial=0)))):
        i = np.flatnonzero((cell[step:] == cell[:-step]) & small[step:])
        yield fit(i, i + step)
    for h, size in zip(heads[sizes > 64].tolist(), sizes[sizes > 64].tolist(), strict=True):
        for i in range(h, h + size - 1):
            others = np.arange(i + 1, h + size)
            yield fit(np.full(len(others), i), others)


def _verified(shared: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """The pairs (x, y) of nodes whose sets have the similarity. Shingles of one text alone are no common ones, so the shared
    ones tell; nodes without a row in shared have no partner."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (c.to_pylist() for c in batch.columns[4:])
            common = np.fromiter((len(np.intersect1d(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), assume_unique=True)) for x, y in zip(a, b, strict=True)), np.int64, batch.num_rows)
            union = batch.column(2).to_numpy() + batch.column(3).to_numpy() - common
            yield batch.select([0, 1]).filter(pa.array(common >= similarity * union - 1e-9))

    of = lambda end: shared.select(F.col("node").alias(end), F.col("n").alias(f"n_{end}"), F.col("shared").alias(f"s_{end}"))
    met = pairs.join(of("x"), "x").join(of("y"), "y").select("x", "y", "n_x", "n_y", "s_x", "s_y")
    return cut(met.mapInArrow(verify, "x long, y long"), "links")


def _anchored(nodes: DataFrame) -> DataFrame:
    """Candidates (x, y) of nodes (node, fp) by the covering code: a star of the nodes with one fingerprint, and the links between
    fingerprints within BITS bits."""
    firsts = cut(nodes.groupBy("fp").agg(F.min("node").alias("first")), "firsts")
    ends = [firsts.select(F.col("fp").alias(e), F.col("first").alias(f"node_{e}")) for e in ("x", "y")]
    near = links(firsts).join(ends[0], "x").join(ends[1], "y").select(F.col("node_x").alias("x"), F.col("node_y").alias("y"))
    star = nodes.join(firsts, "fp").filter("node <> first").select(F.col("first").alias("x"), F.col("node").alias("y"))
    return near.unionAll(star)


def _hubs(rows: DataFrame, similarity: float, turn: int) -> DataFrame:
    """Candidates (x, y): each row (key, node, n, root) with its shingle's hub, the node of least hash. The hubs are cut first, so
    that a shingle which a third of all nodes have is handed its hub over plain exchanges, which adaptive execution can split."""
    order = F.xxhash64(F.lit(turn), "node")
    hubs = cut(rows.groupBy("key").agg(F.min(F.struct(order.alias("o"), "node", "n", "root")).alias("hub"), F.count("*").alias("of")).filter("of > 1"), "hubs")
    fit = F.ceil(F.greatest("n", "hub.n") * similarity - 1e-9) <= F.least("n", "hub.n")
    met = rows.join(hubs, "key").filter((F.col("root") != F.col("hub.root")) & fit)
    return met.select(F.least("node", "hub.node").alias("x"), F.greatest("node", "hub.node").alias("y")).distinct()


def _rest(rows: DataFrame, shared: DataFrame, similarity: float) -> DataFrame:
    """Candidates (x, y): the pairs of unlike roots with a common shingle that may have the similarity, of shingles that have unlike
    roots. A shingle of more than BLOCK such rows is dealt over cells of two blocks each, so no task holds more of it."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _groups(batches):
            cell, node, n, private, root, side = (np.concatenate([r.column(i).to_numpy(zero_copy_only=False) for r in found]) for i in range(6))
            parity = np.frombuffer(b"".join(x for r in found for x in r.column(6).to_pylist()), "<u8").reshape(len(node), -1)
            for x, y in _pairs(cell, node, n, private, root, side, parity, similarity):
                if len(x):
                    yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["x", "y"])

    apart = cut(rows.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count("*").alias("of")).filter("a < b").select("key", F.ceil(F.col("of") / BLOCK).cast("int").alias("blocks")), "apart")
    own = F.pmod(F.xxhash64("node", F.lit(2)), F.col("blocks")).cast("int")
    left = rows.join(apart, "key").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cell = F.when(F.col("blocks") == 1, F.col("key")).otherwise(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")))
    side = F.when(F.col("own") < F.col("other"), 1).when(F.col("own") > F.col("other"), 2).otherwise(0)
    left = left.select(cell.alias("cell"), "node", "root", side.alias("side"))
    sets = shared.select("node", "n", (F.col("n") - F.length("shared") / 8).cast("long").alias("private"), "parity")
    dealt = left.join(sets, "node").select("cell", "node", "n", "private", "root", "side", "parity").repartition("cell").sortWithinPartitions("cell", "node")
    return dealt.mapInArrow(meet, "x long, y long").distinct()


def similar_groups(docs: DataFrame, key: str, text: str, size: int = 5, similarity: float = 0.8) -> DataFrame:
    """(node, root): the smallest key of each distinct set of shingles, and the smallest key of its group. Null keys take no part.

    Texts are linked if their sets of shingles have the Jaccard similarity: exact but for equal hashes of 60 bits. Wordless
    texts are one node, copies are one node. The anchors of SimHash fingerprints and the hubs of rare shingles give the first
    candidates, other hubs the next, and the pairs that are still apart but share a rare shingle the last; each is checked on
    the sets before it links. What is joined already is not compared again, so a large group costs a few pairs for each node.
    """
    small_batches(docs.sparkSession)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signed = [shingle_set(x.as_py(), size) for x in batch.column(1)]
            fps = np.array([fp for _, fp in signed], np.uint64).view(np.int64)
            digests, n = pa.array([_digest(found) for found, _ in signed], pa.binary()), pa.array([len(found) for found, _ in signed], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), digests, pa.array(fps), n], ["doc", "digest", "fp", "n"])

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = [_digest(shingle_set(x.as_py(), size)[0]) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.binary())], ["doc", "text", "digest"])

    rows = docs.filter(F.col(quoted(key)).isNotNull()).select(F.col(quoted(key)).cast("long").alias("doc"), F.col(quoted(text)).alias("text"))
    if _repeats(docs, key):  # one row for each set of shingles of a key: each task folds its own rows first
        rows = cut(rows.mapInArrow(digested, "doc long, text string, digest binary").groupBy("doc", "digest").agg(F.min("text").alias("text")).select("doc", "text"), "folded")
    nodes = cut(rows.mapInArrow(sign, "doc long, digest binary, fp long, n long").groupBy("digest").agg(F.min("doc").alias("node"), F.min("fp").alias("fp"), F.max("n").alias("n")), "nodes")
    total = nodes.agg(F.sum("n")).first()[0] or 0
    # merged, so that the rows of a batch come in the same order if a task is run again
    texts = rows.join(nodes.select(F.col("node").alias("doc"), "digest").hint("merge"), "doc")
    shared = _shared(texts, size, similarity, min(MANY, max(FEWEST, (total // PART).bit_length())))
    prefixes = shared.select("node", "n", F.explode("prefix").alias("key"))

    apart, roots = prefixes.withColumn("root", F.col("node")), None
    turns = (
        lambda: _anchored(nodes.select("node", "fp")).unionAll(_hubs(apart, similarity, 0)).distinct(),
        lambda: _hubs(apart, similarity, 1),
        lambda: _rest(apart, shared, similarity),
    )
    for candidates in turns:
        found = _verified(shared, cut(candidates(), "candidates"), similarity)
        # the groups so far are stars of their roots, which say as much as the links that made them
        edges = found if roots is None else found.unionAll(roots.filter("node <> root").select(F.col("node").alias("x"), F.col("root").alias("y")))
        roots = cut(components(edges), "roots")
        apart = prefixes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return nodes.select("node").join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))


def _repeats(docs: DataFrame, key: str) -> bool:
    """Whether a key has several rows; only keys are read and exchanged."""
    return docs.filter(F.col(quoted(key)).isNotNull()).groupBy(F.col(quoted(key))).count().filter("count > 1").limit(1).count() > 0


def keep_one(docs: DataFrame, key: str, text: str, size: int = 5, similarity: float = 0.8) -> DataFrame:
    """docs with one row of each group of near copies, the one with the smallest key; rows that repeat a key count as copies,
    rows without a key stay. An empty table stays empty; columns may have any names."""
    own, mark = F.col(quoted(key)), fresh(docs, "kept")
    with scratch() as keep:
        kept = keep(cut(similar_groups(docs, key, text, size, similarity).filter("node = root").select(F.col("node").alias(mark)), "kept"))
    stays = docs.filter(own.isNotNull()).join(kept, own.cast("long") == F.col(mark), "left_semi")
    if _repeats(docs, key):  # each task folds its own rows first
        one = F.min_by(F.struct(*columns(docs.columns)), F.xxhash64(F.col(quoted(text)))).alias("one")
        stays = stays.groupBy(own.alias("key")).agg(one).select(*(F.col("one").getField(c).alias(c) for c in docs.columns))
    return stays.unionByName(docs.filter(own.isNull()))


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text")
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))
