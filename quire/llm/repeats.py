"""Exact removal of repeated windows, whatever the tokens are: the part that word and byte deduplication share.

A window is a run of `length` tokens of one document. Each has an anchor, chosen from its content alone, and consecutive
windows with one anchor make a row, so equal windows have equal keys.
1. Rows meet by key, and those whose key occurs once in the corpus are done: none of their windows can repeat.
2. The other rows carry their slice of the text and meet again, sorted by key, slice and place. Equal slices are
   neighbours there, the first of them is the earliest, and the others repeat as a whole; where one key has unlike slices,
   the windows themselves are compared.
3. Windows that also start earlier go back to their documents and cover what is removed.

Every map task first folds what it holds itself (step 1 into a count, step 2 into its earliest row), so a frequent key or
slice sends a few rows per task however often it occurs. A key of more than WIDE rows is dealt by whole windows in step 2,
not by key: equal windows are decided as they stream by, so a task holds no more than WIDE rows of a key whatever the size
of the corpus. Which keys are that wide is joined to the rows; nothing of it reaches the driver. Earlier means: smaller
doc_id, or the same and an earlier start. A null doc_id comes before all others. Rows with the same id and text are one
document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import NULL_ID, columns, cut, order_id, quoted, small_batches

#: A key with more rows than this is dealt out by window.
WIDE = 4096
#: A key that a batch has so often is frequent; a task remembers so many frequent keys, and so many bytes of repeated slices.
FREQUENT, KEYS, BYTES_KEPT = 4, 1 << 16, 1 << 24
#: Windows of unlike slices compared together.
WINDOWS = 1 << 16
#: Documents, or rows of a shuffled table, that a Python worker works on at a time.
DOCS, ROWS = 2048, 2048
_I64 = np.int64


@dataclass(frozen=True)
class Kind:
    """What the tokens are.

    anchors: texts to (row of texts, first window, windows, key) arrays, rows of a text in order of their first window.
    slices: a text's slices for (first window, windows) pairs. split: a slice of n windows to its n single windows.
    later: for slices, their numbers of windows and the windows' ranks (their order in the corpus, equal for one place):
    whether an equal window has a smaller rank.
    """

    length: int
    anchors: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    slices: Callable[[bytes, np.ndarray, np.ndarray], list[bytes]]
    split: Callable[[bytes, int], list[bytes]]
    later: Callable[[list[bytes], np.ndarray, np.ndarray], np.ndarray]


def _batch(names: str, *cols: np.ndarray | pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cols], names.split())


def sliced(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices of so many rows, which bounds what a Python worker holds beside its batch."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def _scatter(doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A key that deals rows out evenly."""
    return _mix(doc.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + start.astype(np.uint64)).view(_I64)


def _find_anchors(kind: Kind) -> Callable:
    """Rows by part. The first row of a key in a batch goes to the key and says how often it was seen; the others, and all
    rows of a key already known to be frequent in this task, are repeated for certain and go anywhere (seen 0). What was
    seen of frequent keys after that is told at the end, by rows with n = 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = np.empty(0, _I64)
        more = np.empty(0, _I64)
        for batch in sliced(batches, DOCS):
            doc, tag = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            texts = [x.as_py().encode() for x in batch.column(2)]
            row, start, n, key = kind.anchors(texts)
            order = np.argsort(key, kind="stable")
            head = np.r_[True, key[order][1:] != key[order][:-1]] if len(key) else np.empty(0, bool)
            counts = np.diff(np.r_[np.flatnonzero(head), len(key)])
            names = key[order[head]]
            at = np.searchsorted(frequent, names)
            known = np.r_[frequent, _I64(0)][at] == names if len(frequent) else np.zeros(len(names), bool)
            known &= at < len(frequent)
            more[at[known]] += counts[known]
            first = np.zeros(len(key), bool)
            first[order[head][~known]] = True
            count = np.zeros(len(key), _I64)
            count[order[head][~known]] = counts[~known]
            part = np.where(first, key, _scatter(doc[row], start))
            # a key that is the part itself needs no second copy
            yield _batch("part key seen doc tag start n", part, np.where(first, 0, key), count, doc[row], tag[row], start.astype(_I64), n.astype(np.int32))
            new = names[~known & (counts >= FREQUENT)][: max(0, KEYS - len(frequent))]
            if len(new):
                order = np.argsort(np.r_[frequent, new], kind="stable")
                frequent, more = np.r_[frequent, new][order], np.r_[more, np.zeros(len(new), _I64)][order]
        frequent, more = frequent[more > 0], more[more > 0]
        if len(frequent):
            zero = np.zeros(len(frequent), _I64)
            yield _batch("part key seen doc tag start n", frequent, zero, more, zero, zero, zero, zero.astype(np.int32))

    return run


def _find_repeated(most: int) -> Callable:
    """Rows whose key occurs again, and a row with n = 0 for each wide key. Rows come sorted by part; a part is held as long as
    it lasts, which is a few rows of each task that has its key."""

    def told(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        part, key, seen, doc, tag, start, n = rows
        key = np.where(seen > 0, part, key)
        head = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        total = np.add.reduceat(seen, head)
        each = np.repeat(total, np.diff(np.r_[head, len(part)]))
        take = (n > 0) & ((seen == 0) | (each >= 2))
        if take.any():
            yield _batch("key doc tag start n", key[take], doc[take], tag[take], start[take], n[take].astype(np.int32))
        wide = part[head[total > most]]
        if len(wide):
            zero = np.zeros(len(wide), _I64)
            yield _batch("key doc tag start n", wide, zero, zero, zero, zero.astype(np.int32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.empty((7, 0), _I64)
        for batch in batches:
            rows = np.concatenate([rest, np.stack([c.to_numpy(zero_copy_only=False).astype(_I64) for c in batch.columns])], axis=1)
            whole = int(np.searchsorted(rows[0], rows[0, -1], side="left")) if rows.shape[1] else 0
            if whole:
                yield from told(rows[:, :whole])
            rest = rows[:, whole:]
        if rest.shape[1]:
            yield from told(rest)

    return run


def _cut_slices(kind: Kind) -> Callable:
    """Rows with their slices; those that equal an earlier row known to the task are repeats already (slice null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        often: dict[tuple[int, bytes], tuple[int, int]] = {}
        room = BYTES_KEPT
        for batch in sliced(batches, DOCS):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            tags = batch.column(1).to_numpy(zero_copy_only=False)
            known: dict[tuple[int, bytes], tuple[int, int]] = {}
            again: set[tuple[int, bytes]] = set()
            cols: list[list] = [[] for _ in range(6)]
            for i in np.argsort(ids, kind="stable").tolist():
                doc, tag = int(ids[i]), int(tags[i])
                rows = batch.column(3)[i].values
                start, n, key, wide = (rows.field(c).to_numpy(zero_copy_only=False) for c in ("start", "n", "key", "wide"))
                # rows of one document come as often as the document does
                order = np.unique(np.stack([start, key]), axis=1, return_index=True)[1] if len(start) > 1 else np.arange(len(start))
                start, n, key, wide = start[order], n[order], key[order], wide[order]
                slices = kind.slices(batch.column(2)[i].as_py().encode(), start, n)
                for k, s, m, by_window, text in zip(key.tolist(), start.tolist(), n.tolist(), wide.tolist(), slices, strict=True):
                    parts = [(k, s, m, text)]
                    if by_window:
                        parts = [(xxhash.xxh64_intdigest(w, 7) - 2**63, s + j, 1, w) for j, w in enumerate(kind.split(text, m))]
                    for route, at, m_, piece in parts:
                        name, place = (route, piece), (doc, at)
                        before = known.get(name)
                        if before is None:
                            before = often.get(name, place)
                            known[name] = min(before, place)
                        elif before < place:
                            again.add(name)
                        for c, v in zip(cols, (route, doc, tag, at, m_, None if before < place else piece), strict=True):
                            c.append(v)
            for name in again:
                if name in often or room > 0:
                    room -= 0 if name in often else len(name[1]) + 200
                    often[name] = known[name]
            route, doc_, tag_, at_ = (np.array(c, _I64) for c in cols[:4])
            told = np.array([x is None for x in cols[5]], bool)
            route = np.where(told, _scatter(doc_, at_), route) if len(route) else route
            yield _batch("route doc tag start n slice", route, doc_, tag_, at_, np.array(cols[4], np.int32), pa.array(cols[5], pa.binary()))

    return run


class _Unlike:
    """Unlike slices of keys, and the windows among them that start earlier too. What is told so far can be asked for at the end
    of any key."""

    def __init__(self, kind: Kind) -> None:
        self.kind = kind
        self.rows: list[tuple[int, int, int, int, bytes]] = []
        self.key: list[tuple[int, int, int, int, bytes]] = []
        self.windows = 0

    def add(self, row: tuple[int, int, int, int, bytes]) -> None:
        self.key.append(row)

    def end(self) -> None:
        """The key is over: its rows count if their slices are not all the same."""
        if len(self.key) > 1 and any(r[4] != self.key[0][4] for r in self.key):
            self.rows += self.key
            self.windows += sum(r[3] for r in self.key)
        self.key = []

    def told(self) -> pa.RecordBatch | None:
        if not self.rows:
            return None
        rows = sorted(self.rows, key=lambda r: (r[0], r[2]))
        doc, tag, start, m = (np.array([r[i] for r in rows], _I64) for i in range(4))
        owner = np.repeat(np.arange(len(rows)), m)
        at = np.repeat(start - (np.cumsum(m) - m), m) + np.arange(len(owner))
        who = doc[owner]
        order = np.lexsort((at, who))
        rank = np.empty(len(order), _I64)
        rank[order] = np.cumsum(np.r_[False, (np.diff(who[order]) != 0) | (np.diff(at[order]) != 0)])
        again = self.kind.later([r[4] for r in rows], m, rank)
        edge = np.r_[True, (owner[1:] != owner[:-1]) | (again[1:] != again[:-1])]
        begin = np.flatnonzero(edge)
        size = np.diff(np.r_[begin, len(owner)])
        begin, size = begin[again[begin]], size[again[begin]]
        self.rows, self.windows = [], 0
        return _batch("doc tag start n", who[begin], tag[owner[begin]], at[begin], size.astype(np.int32))


def _find_later(kind: Kind) -> Callable:
    """Windows that also start earlier, as rows of consecutive ones. Rows come sorted by route, slice, doc and start, so of
    equal slices the first is the earliest: only it, and rows of other texts at the very same place, are held for the
    comparison with unlike slices of the key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unlike = _Unlike(kind)
        now: tuple[int, bytes] | None = None
        place, tags_there = (0, 0), set()
        for batch in sliced(batches, ROWS):
            route, doc, tag, start, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            slices = batch.column(5)
            told = slices.is_null().to_numpy(zero_copy_only=False)
            later = told.copy()
            for i in np.flatnonzero(~told).tolist():
                key, text = int(route[i]), slices[i].as_py()
                here = int(doc[i]), int(start[i])
                if now is not None and now == (key, text):
                    if here != place:
                        later[i] = True
                        continue
                    if int(tag[i]) in tags_there:
                        continue
                else:
                    if now is None or now[0] != key:
                        unlike.end()
                        if unlike.windows > WINDOWS:
                            yield unlike.told()
                    now, place, tags_there = (key, text), here, set()
                tags_there.add(int(tag[i]))
                unlike.add((here[0], int(tag[i]), here[1], int(n[i]), text))
            if later.any():
                yield _batch("doc tag start n", doc[later], tag[later], start[later], n[later])
        unlike.end()
        last = unlike.told()
        if last is not None:
            yield last

    return run


def with_spans(docs: DataFrame, doc: str, text: str, kind: Kind) -> DataFrame:
    """doc_, text_, spans and row_ for every row of docs: the id, the text (null becomes empty), null or an array of
    (start, n) runs of windows that also start earlier, and a struct of others (a struct of the other columns) and null_
    (whether the text is null)."""
    small_batches(docs.sparkSession)
    whole = F.col(quoted(text))
    twice = docs.groupBy(F.col(quoted(doc))).count().filter("count > 1").limit(1).count()
    # only ids that have several rows need the text to tell these apart; a literal 0 would be folded into one of the two
    # joins below, and the exchange of the texts would not be read twice but made twice
    tag = F.xxhash64(F.coalesce(whole, F.lit(""))) if twice else F.least(F.coalesce(F.length(whole), F.lit(0)), F.lit(0)).cast("long")
    others = F.struct(*columns(c for c in docs.columns if c.lower() != text.lower()))
    rows = docs.select(order_id(doc).alias("id_"), tag.alias("tag_"), F.coalesce(whole, F.lit("")).alias("text_"), F.struct(others.alias("others"), whole.isNull().alias("null_")).alias("row_"))
    once = rows
    if twice:  # a text that an id has many times is searched once; each task folds its own rows before the exchange
        once = cut(rows.groupBy("id_", "tag_").agg(F.min("text_").alias("text_")).withColumn("row_", F.lit(0)), "once")
    met = once.select("id_", "tag_", "text_").mapInArrow(_find_anchors(kind), "part bigint, key bigint, seen bigint, doc bigint, tag bigint, start bigint, n int")
    repeated = cut(met.repartition("part").sortWithinPartitions("part").mapInArrow(_find_repeated(WIDE), "key bigint, doc bigint, tag bigint, start bigint, n int"), "repeated")
    # a table of its own: where its size allows it is broadcast, and the rows need no exchange by key
    wide = cut(repeated.filter("n = 0").select("key").distinct(), "wide")
    marked = repeated.filter("n > 0").join(wide.withColumn("wide", F.lit(True)), "key", "left").withColumn("wide", F.coalesce("wide", F.lit(False)))
    asked = marked.groupBy("doc", "tag").agg(F.collect_list(F.struct("start", "n", "key", "wide")).alias("rows"))
    # both joins need the same columns of rows, so that they read one exchange of the texts
    held = once.join(asked, (F.col("id_") == F.col("doc")) & (F.col("tag_") == F.col("tag"))).select("id_", "tag_", "text_", "rows", "row_")
    slices = held.mapInArrow(_cut_slices(kind), "route bigint, doc bigint, tag bigint, start bigint, n int, slice binary")
    later = slices.repartition("route").sortWithinPartitions("route", "slice", "doc", "start").mapInArrow(_find_later(kind), "id_ bigint, tag_ bigint, start bigint, n int")
    spans = later.groupBy("id_", "tag_").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    own = F.when(F.col("id_") != NULL_ID, F.col("id_")).cast(docs.schema[doc].dataType)
    return rows.join(spans, ["id_", "tag_"], "left").select(own.alias("doc_"), "text_", "spans", "row_")


def covered(spans: list[dict] | None, length: int) -> np.ndarray:
    """The maximal runs (begin, end) of tokens that windows cover; spans holds runs of windows."""
    if not spans:
        return np.empty((0, 2), _I64)
    s = np.array(sorted((x["start"], x["start"] + x["n"] - 1 + length) for x in spans), _I64)
    ends = np.maximum.accumulate(s[:, 1])
    head = np.r_[True, s[1:, 0] > ends[:-1]]
    last = np.r_[np.flatnonzero(head)[1:] - 1, len(s) - 1]
    return np.column_stack([s[head, 0], ends[last]])
