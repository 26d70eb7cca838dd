"""Byte-level dedup by longest-previous-factor arrays.

LPF[i] is the length of the longest string at i that also starts at an earlier place. In suffix order the best such place
is the previous or the next suffix with a smaller place (PSV or NSV), so LPF[i] is the larger of the two common prefixes.
A byte goes if it is within 100 bytes from an i with LPF[i] >= 100; the earliest copy stays. What shares an anchor (the
20 bytes of least hash in each 100-byte string) is gathered first, and the arrays are built over such groups.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from quire.llm.common import table
from quire.llm.repeats import Kind, _mix, covered, sliced, with_spans

LENGTH, GRAM = 100, 20
#: Bytes hashed together.
PART = 1 << 20
_U = np.uint64
_M = _U(0x9E3779B97F4A7C15)


def suffix_order(data: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """starts in lexicographic order of the depth bytes that follow; data must reach depth past each. Ties keep their order."""
    if not len(starts):
        return starts
    rows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, depth)[starts])
    keys = pa.FixedSizeBinaryArray.from_buffers(pa.binary(depth), len(starts), [None, pa.py_buffer(rows)])
    return starts[pc.array_sort_indices(keys).to_numpy()]


def common_prefixes(data: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """For each suffix in order the bytes, depth at most, that it shares with the one before it (0 for the first)."""
    lcp = np.zeros(len(order), np.int64)
    live = np.arange(1, len(order))
    for at in range(0, depth, 10):
        if not len(live):
            break
        offsets = np.arange(at, min(at + 10, depth))
        same = data[order[live, None] + offsets] == data[order[live - 1, None] + offsets]
        whole = same.all(axis=1)
        lcp[live] += np.where(whole, len(offsets), same.argmin(axis=1))
        live = live[whole]
    return lcp


def longest_previous(rank: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """LPF of suffixes in suffix order. rank: each one's place in the corpus; lcp: its common prefix with the one before.

    One pass keeps a stack of suffixes with rising ranks, each with the prefix it shares with the one below. What is on
    top when a suffix has popped all later ones is its PSV, and the suffix that pops another is that one's NSV.
    """
    best = [0] * len(rank)
    ranks: list[int] = [-1]
    stack: list[tuple[int, int]] = []
    for i, (r, shared) in enumerate(zip(rank.tolist(), lcp.tolist(), strict=True)):
        while ranks[-1] > r:
            ranks.pop()
            j, below = stack.pop()
            if shared > best[j]:
                best[j] = shared
            if below < shared:
                shared = below
        best[i] = shared
        ranks.append(r)
        stack.append((i, shared))
    return np.array(best, np.int64)


def _anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    found: list[list[np.ndarray]] = [[], [], [], []]
    held: list[tuple[int, int, bytes]] = []
    size = 0
    spread = LENGTH - GRAM + 1  # grams of a string

    def flush() -> None:
        nonlocal size
        if not held:
            return
        data = np.frombuffer(b"".join(h[2] for h in held), np.uint8)
        lengths = np.array([len(h[2]) for h in held])
        base = np.cumsum(lengths) - lengths
        gram = (data + _U(1)) * _U(0xC2B2AE3D27D4EB4F)
        done = 1
        while done < GRAM:  # from the hash of `done` bytes to that of `step` more
            step = min(done, GRAM - done)
            gram = _mix(gram[: len(gram) - step] * _M + gram[step:])
            done += step
        least = (gram >> _U(24) << _U(24)) | np.arange(len(gram), dtype=_U)
        done = 1
        while done < spread:
            step = min(done, spread - done)
            least = np.minimum(least[: len(least) - step], least[step:])
            done += step
        place = (least & _U((1 << 24) - 1)).astype(np.int64)
        count = lengths - LENGTH + 1
        seg = np.repeat(np.arange(len(held)), count)
        at = np.repeat(base - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        place = place[at]
        head = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (seg[1:] != seg[:-1])])
        s = seg[head]
        found[0].append(np.array([h[0] for h in held])[s])
        found[1].append(at[head] - base[s] + np.array([h[1] for h in held])[s])
        found[2].append(np.diff(np.r_[head, len(place)]))
        found[3].append(gram[place[head]].view(np.int64))
        held.clear()
        size = 0

    for i, text in enumerate(texts):
        for at in range(0, len(text) - LENGTH + 1, PART):
            held.append((i, at, text[at : at + PART + LENGTH - 1]))
            size += len(held[-1][2])
            if size >= PART:
                flush()
    flush()
    return tuple(np.concatenate(c) if c else np.empty(0, np.int64) for c in found)


def _slices(text: bytes, start: np.ndarray, n: np.ndarray) -> list[bytes]:
    return [text[s : s + m - 1 + LENGTH] for s, m in zip(start.tolist(), n.tolist(), strict=True)]


def _split(text: bytes, n: int) -> list[bytes]:
    return [text[i : i + LENGTH] for i in range(n)]


def _later(slices: list[bytes], n: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether a string's LPF reaches its length, in parts of slices that share no string with other parts."""
    data = np.frombuffer(b"".join(slices), np.uint8)
    base = np.cumsum(n + LENGTH - 1) - (n + LENGTH - 1)
    starts = np.repeat(base - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    by_start = np.empty(len(data), np.int64)
    by_start[starts] = np.arange(len(starts))
    order = suffix_order(data, starts, LENGTH)
    index = by_start[order]
    lcp = common_prefixes(data, order, LENGTH)
    # one place of a document that has several rows: equal neighbours, of which one is enough
    fresh = np.r_[True, (lcp[1:] < LENGTH) | (place[index][1:] != place[index][:-1])]
    lpf = longest_previous(place[index][fresh], lcp[fresh])
    out = np.empty(len(starts), bool)
    out[index] = (lpf >= LENGTH)[np.cumsum(fresh) - 1]
    return out


BYTES = Kind(LENGTH, _anchors, _slices, _split, _later)


def removal_digest(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, n_bytes, n_removed, n_spans and kept_sha256 for every row: what remains of the text's UTF-8 without bytes that
    a 100-byte string covers which also starts earlier. Null text is empty; texts under 100 bytes lose nothing."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 512):
            total, lost, n_spans, sha = [], [], [], []
            for x, s in zip(batch.column(1), batch.column(2), strict=True):
                data = (x.as_py() or "").encode()
                runs = covered(s.as_py(), LENGTH).tolist()
                total.append(len(data))
                lost.append(sum(b - a for a, b in runs))
                n_spans.append(len(runs))
                edges = [0, *(v for r in runs for v in r), len(data)]
                sha.append(hashlib.sha256(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))).hexdigest())
            cols = [pa.array(c, pa.int64()) for c in (total, lost, n_spans)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols, pa.array(sha)], ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return with_spans(docs, key, text, BYTES).mapInArrow(run, f"key {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string").withColumnRenamed("key", key)


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_digest(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")
