"""Word-level substring dedup by recompression.

Rounds rename a document's words: maximal runs of one symbol become a symbol, then neighbours of unlike class become a
symbol. A name is a hash of what it stands for, so all tasks name alike without asking each other, and equal passages get
equal symbols inside. Each symbol knows the words that settle it; if those lie in a window, every equal window has the
symbol too. A window's anchor is the symbol of least hash on the highest level that is settled inside it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quire.llm.common import table
from quire.llm.repeats import Kind, _mix, covered, sliced, with_spans

WINDOW, ROUNDS = 20, 2
#: Words looked at together, and the context kept on each side of a part of a longer document.
PART, MARGIN = 200_000, 128
_U = np.uint64
_M = _U(0x9E3779B97F4A7C15)
_M_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 2**64))


def _names(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), _U, len(words))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, _U)
    out[:1] = 1
    return np.multiply.accumulate(out) if n else out


def _round(level: int, name: np.ndarray, lo: np.ndarray, hi: np.ndarray, seg: np.ndarray, edges: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, ...]:
    """One round of naming runs, then pairs. lo and hi bound the words that settle a symbol; past a segment's end they
    leave the segment, for what is there is not part of any window."""
    if not len(name):
        return name, lo, hi, seg
    before, after = edges

    def sides(lo: np.ndarray, hi: np.ndarray, seg: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        left, right = np.empty_like(lo), np.empty_like(hi)
        left[1:], right[:-1] = lo[:-1], hi[1:]
        first = np.r_[True, seg[1:] != seg[:-1]]
        last = np.r_[first[1:], True]
        left[first], right[last] = before[seg[first]], after[seg[last]]
        return left, right

    left, right = sides(lo, hi, seg)
    head = np.flatnonzero(np.r_[True, (name[1:] != name[:-1]) | (seg[1:] != seg[:-1])])
    tail = np.r_[head[1:], len(name)] - 1
    size = tail - head + 1
    run = _mix(name[head] + size.astype(_U) * _M + _U(2 * level + 1))
    name, seg = np.where(size > 1, run, name[head]), seg[head]
    lo = np.minimum(np.minimum.reduceat(lo, head), left[head])
    hi = np.maximum(np.maximum.reduceat(hi, head), right[tail])
    left, right = sides(lo, hi, seg)
    salt = _U((int(_M) * (level + 11)) % 2**64)
    upper = (_mix(name ^ salt) >> _U(40)) & _U(1) == 1
    pair = np.zeros(len(name), bool)
    pair[:-1] = ~upper[:-1] & upper[1:] & (seg[1:] == seg[:-1])
    second = np.r_[False, pair[:-1]]
    nxt = np.minimum(np.arange(len(name)) + 1, len(name) - 1)
    both = _mix((name * _M) ^ (_mix(name[nxt] + _U(level)) + _U(2 * level)))
    new_lo = np.where(pair, np.minimum(lo, lo[nxt]), np.where(upper, np.minimum(lo, left), lo))
    new_hi = np.where(pair, np.maximum(hi, hi[nxt]), np.where(upper, hi, np.maximum(hi, right)))
    keep = ~second
    return np.where(pair, both, name)[keep], new_lo[keep], new_hi[keep], seg[keep]


def _anchor_part(name: np.ndarray, seg: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every word that begins a window of its segment: its place, and the key and place of the window's anchor."""
    total = len(name)
    bounds = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1], True])
    begin, end = bounds[:-1], bounds[1:]
    edges = begin - 1, end + 1
    prefix = np.r_[_U(0), np.cumsum(name * _powers(_M, total), dtype=_U)]
    unpower = _powers(_M_INVERSE, total + 1)
    lo, hi = np.arange(total), np.arange(1, total + 1)
    number = np.repeat(np.arange(len(begin)), end - begin)
    levels = [(name, lo, hi, number)]
    for level in range(ROUNDS):
        levels.append(_round(level, *levels[-1], edges))
    starts = np.zeros(total, bool)
    for b, e in zip(begin.tolist(), end.tolist(), strict=True):
        starts[b : max(b, e - WINDOW + 1)] = True
    key, place = np.zeros(total, _U), np.zeros(total, np.int64)
    open_ = starts.copy()
    for name_, lo_, hi_, number_ in reversed(levels):
        if not open_.any():
            break
        usable = np.flatnonzero((hi_ - lo_ <= WINDOW) & (lo_ >= begin[number_]) & (hi_ <= end[number_]))
        a, b = lo_[usable], hi_[usable]
        settled = (prefix[b] - prefix[a]) * unpower[a]
        settled = _mix(settled + _M * (b - a).astype(_U)) ^ name_[usable]
        rank = _mix(settled + _U(77))
        packed = (rank >> _U(24) << _U(24)) | np.arange(len(usable), dtype=_U)
        best = np.full(total, ~_U(0))
        for d in range(WINDOW):
            at = a - d
            ok = (at >= 0) & (at + WINDOW >= b)
            np.minimum.at(best, at[ok], packed[ok])
        got = np.flatnonzero(open_ & (best != ~_U(0)))
        owner = (best[got] & _U((1 << 24) - 1)).astype(np.int64)
        key[got] = settled[owner]
        place[got] = a[owner]
        open_[got] = False
    at = np.flatnonzero(starts)
    return at, key[at], place[at]


def _anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    found: list[list[np.ndarray]] = [[], [], [], []]
    held: list[tuple[int, int, int, int, list[bytes]]] = []
    size = 0

    def flush() -> None:
        nonlocal size
        if not held:
            return
        name = np.concatenate([_names(h[4]) for h in held])
        lengths = np.array([len(h[4]) for h in held])
        seg = np.repeat(np.arange(len(held)), lengths)
        base = np.cumsum(lengths) - lengths
        at, key, place = _anchor_part(name, seg)
        s = seg[at]
        shift = np.array([h[1] for h in held])
        local = at - base[s] + shift[s]
        core = (local >= np.array([h[2] for h in held])[s]) & (local < np.array([h[3] for h in held])[s])
        s, local, key, place = s[core], local[core], key[core], place[core]
        head = np.flatnonzero(np.r_[True, (s[1:] != s[:-1]) | (key[1:] != key[:-1]) | (place[1:] != place[:-1]) | (np.diff(local) != 1)]) if len(s) else np.empty(0, np.int64)
        found[0].append(np.array([h[0] for h in held])[s[head]])
        found[1].append(local[head])
        found[2].append(np.diff(np.r_[head, len(s)]))
        found[3].append(key[head].view(np.int64))
        held.clear()
        size = 0

    for i, text in enumerate(texts):
        words = text.split()
        for at in range(0, max(0, len(words) - WINDOW + 1), PART):
            a, b = max(0, at - MARGIN), min(len(words), at + PART + WINDOW - 1 + MARGIN)
            held.append((i, a, at, at + PART, words[a:b]))
            size += b - a
            if size >= PART:
                flush()
    flush()
    return tuple(np.concatenate(c) if c else np.empty(0, np.int64) for c in found)


def _slices(text: bytes, start: np.ndarray, n: np.ndarray) -> list[bytes]:
    words = text.split()
    return [b" ".join(words[s : s + m - 1 + WINDOW]) for s, m in zip(start.tolist(), n.tolist(), strict=True)]


def _split(text: bytes, n: int) -> list[bytes]:
    words = text.split(b" ")
    return [b" ".join(words[i : i + WINDOW]) for i in range(n)]


def _later(slices: list[bytes], n: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Words are numbered, then pairs of numbers stand for twice as many words, up to whole windows: equal windows have
    equal numbers and no others do. A window is later if its number occurs at a smaller place."""
    number: dict[bytes, int] = {}
    rank = np.array([number.setdefault(w, len(number)) for x in slices for w in x.split(b" ")], np.int64)

    def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.unique(a << 32 | b, return_inverse=True)[1].astype(np.int64)

    ranks = {1: rank}
    done = 1
    while done * 2 <= WINDOW:
        r = ranks[done]
        ranks[done * 2] = paired(r, np.r_[r[done:], np.zeros(min(done, len(r)), np.int64)])
        done *= 2
    out, have = ranks[done], done
    for step in sorted(ranks, reverse=True):
        while have + step <= WINDOW:
            r = ranks[step]
            out = paired(out, np.r_[r[have:], np.zeros(min(have, len(r)), np.int64)])
            have += step
    base = np.cumsum(n + WINDOW - 1) - (n + WINDOW - 1)
    at = np.repeat(base - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    least = np.full(len(out), np.iinfo(np.int64).max)
    np.minimum.at(least, out[at], place)
    return place > least[out[at]]


WORDS = Kind(WINDOW, _anchors, _slices, _split, _later)


def removal_digest(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, n_words, n_removed and kept_sha256 for every row: what remains without words that a window covers which also
    starts earlier. Words are runs without ASCII white space; null text has none; texts under 20 words lose nothing."""
    found = with_spans(docs, key, text, WORDS)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 512):
            total, lost, sha = [], [], []
            for x, s in zip(batch.column(1), batch.column(2), strict=True):
                words = (x.as_py() or "").encode().split()
                runs = covered(s.as_py(), WINDOW)
                total.append(len(words))
                lost.append(int((runs[:, 1] - runs[:, 0]).sum()))
                for a, b in runs[::-1].tolist():
                    del words[a:b]
                sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total, pa.int64()), pa.array(lost, pa.int64()), pa.array(sha)], ["key", "n_words", "n_removed", "kept_sha256"])

    return found.mapInArrow(run, f"key {kind}, n_words bigint, n_removed bigint, kept_sha256 string").withColumnRenamed("key", key)


def remove_repeats(docs: DataFrame, key: str, text: str) -> DataFrame:
    """docs without repeated words: each word that such a window covers goes, with the white space after it. A text that
    loses nothing stays as it is; one that loses every word leaves a row only if it had none before. All columns stay."""
    gap = re.compile(rb"[\x20\x09-\x0D]+")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 512):
            out, lost = [], []
            for x, s in zip(batch.column(1), batch.column(2), strict=True):
                if not s.is_valid:
                    out.append(x.as_py())
                    lost.append(False)
                    continue
                data = x.as_py().encode()
                words = [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", data)]
                parts, at = [], 0
                runs = covered(s.as_py(), WINDOW).tolist()
                for a, b in runs:
                    parts.append(data[at : words[a][0]])
                    behind = gap.match(data, words[b - 1][1])
                    at = behind.end() if behind else words[b - 1][1]
                parts.append(data[at:])
                out.append(b"".join(parts).decode())
                lost.append(sum(b - a for a, b in runs) == len(words))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), pa.array(lost), batch.column(3)], ["text", "lost", "row_"])

    found = with_spans(docs, key, text, WORDS)
    kept = found.mapInArrow(run, StructType().add("text", "string").add("lost", "boolean").add(found.schema["row_"])).filter("NOT lost")
    back = F.when(~F.col("row_.null_"), F.col("text")).alias(text)
    return kept.select(*(back if c.lower() == text.lower() else F.col("row_.others")[c].alias(c) for c in docs.columns))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_digest(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")
