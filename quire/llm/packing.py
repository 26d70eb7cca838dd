"""Vector best-fit packing: documents become token pieces, and pieces fill sequences under several capacities at once.

A sequence has a capacity for tokens, for documents and for attention cost (the sum of squared piece lengths). A piece may
go to any open sequence that has room for it in every dimension; the one with the smallest weighted norm of what would
remain, or the largest weighted dot product of what remains and what the piece needs, takes it.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import cut, quoted, small_batches, table

MAX_TOKENS = 2048
#: A shard of the packing holds about this many full sequences, and no more than so many pieces on average.
SHARD_SEQUENCES, SHARD_PIECES = 1024, 25_000
PIECES = "piece int, start bigint, length bigint, ids_crc32 bigint"


@lru_cache(maxsize=2)
def byte_bpe(ranks_path: str, special: tuple[tuple[str, int], ...]) -> Callable[[str], list[int]]:
    """Text to ids with the ranks of a byte-level BPE; special strings get their own ids, as the tokenizer file has them."""
    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    named = dict(special)
    coder = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=named)
    names = set(named)
    return lambda text: coder.encode(text, allowed_special=names, disallowed_special=())


def cuts(total: int, most: int) -> Iterator[tuple[int, int]]:
    """(start, length) of a document's pieces: all have most tokens but the first, which has what is left over."""
    at = 0
    length = total % most or most
    while at < total:
        yield at, length
        at, length = at + length, most


def tokenize(docs: DataFrame, key: str, text: str, most: int = MAX_TOKENS, ranks_path: str | None = None, special: tuple[tuple[str, int], ...] = (("<|endoftext|>", 50256),), end_id: int = 0) -> DataFrame:
    """One row per piece: key, piece (from 0), start, length, ids_crc32 (of little-endian 32-bit ids).

    The ids are those of the byte-level BPE file of 50,257 entries; its ranks file gives the same ids in a quarter of the
    time. Null text counts as empty, so it is the end id alone. Null keys and repeated rows are kept.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        ids_of = byte_bpe(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), special)
        for batch in batches:
            take: list[int] = []
            cols: list[list[int]] = [[], [], [], []]
            for row, x in enumerate(batch.column(1)):
                ids = np.array([*ids_of(x.as_py() or ""), end_id], "<u4")
                for n, (start, length) in enumerate(cuts(len(ids), most)):
                    take.append(row)
                    for c, v in zip(cols, (n, start, length, zlib.crc32(ids[start : start + length].tobytes())), strict=True):
                        c.append(v)
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(take, pa.int64())), *map(pa.array, cols, kinds)], ["key", "piece", "start", "length", "ids_crc32"])

    small_batches(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).alias("text")).mapInArrow(encode, f"key {kind}, {PIECES}").withColumnRenamed("key", key)


def best_fit(sizes: np.ndarray, capacity: np.ndarray, weights: np.ndarray, rule: str = "norm") -> tuple[np.ndarray, int]:
    """The bin of each item and the number of bins. sizes: (items, dimensions), every item within capacity; largest weighted item first."""
    need, w = sizes / capacity, np.asarray(weights, float)
    order = np.lexsort((np.arange(len(need)), -(need * w).sum(axis=1)))
    left = np.empty((max(1, len(need)), len(capacity)))
    bins, used, slack = np.full(len(need), -1, np.int64), 0, 1e-9
    open_ = np.empty(0, np.int64)
    alone = (need >= 1 - slack).any(axis=1)
    for i in order:
        chosen = -1
        if not alone[i] and len(open_):
            rest = left[open_] - need[i]
            fits = (rest >= -slack).all(axis=1)
            if fits.any():
                score = -((rest * rest) @ w) if rule == "norm" else (left[open_] * need[i]) @ w
                score[~fits] = -np.inf
                chosen = int(open_[int(np.argmax(score))])
                left[chosen] -= need[i]
                if (left[chosen] <= slack).any():
                    open_ = open_[open_ != chosen]
        if chosen < 0:
            chosen, used = used, used + 1
            left[chosen] = 1 - need[i]
            if not (left[chosen] <= slack).any():
                open_ = np.append(open_, chosen)
        bins[i] = chosen
    return bins, used


def pack(pieces: DataFrame, key: str, max_tokens: int = MAX_TOKENS, max_documents: int | None = None, max_cost: int | None = None, weights: tuple[float, float, float] = (1.0, 0.1, 0.1), rule: str = "norm") -> DataFrame:
    """pieces with sequence_id and offset (the place in the sequence, gapless from 0). pieces must be a table that was cut.

    Pieces are dealt over shards by a hash of their rows, repeated ones too, so a shard holds a fair sample of all lengths whatever the sources are, and
    each shard packs on its own: at most one sequence of a shard stays ill filled. The number of shards follows the input,
    so a shard's memory does not. max_documents and max_cost default to what max_tokens alone allows, so that they cost no
    sequence; their residuals weigh in the choice of a bin all the same. Null keys and repeated rows keep their pieces, an
    empty table gives none.
    """
    caps = np.array([max_tokens, max_documents or max_tokens, max_cost or max_tokens**2], float)
    total = pieces.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("tokens"), F.count("*").alias("n")).first()
    shards = max(1, -(-total.tokens // (SHARD_SEQUENCES * max_tokens)), -(-total.n // SHARD_PIECES))

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["key", "piece", "ids_crc32"], kind="stable", ignore_index=True)
        length = pdf.length.to_numpy(float)
        bins, _ = best_fit(np.column_stack([length, np.ones(len(pdf)), length**2]), caps, np.array(weights), rule)
        order = np.argsort(bins, kind="stable")
        before = np.cumsum(length[order]) - length[order]
        head = np.r_[True, np.diff(bins[order]) != 0]
        offset = np.empty(len(pdf), np.int64)
        offset[order] = before - before[head][np.cumsum(head) - 1]
        return pdf.assign(sequence_id=(pdf.shard.to_numpy(np.int64) << 32) | bins, offset=offset).drop(columns="shard")

    kind = pieces.schema[key].dataType.simpleString()
    # a row's number in the cut table parts repeated rows, of which a third of all may be one; a task that is run again gives the same
    own = F.xxhash64("key", "piece", "ids_crc32", F.monotonically_increasing_id())
    named = pieces.select(F.col(quoted(key)).alias("key"), "piece", "start", "length", "ids_crc32")
    dealt = named.withColumn("shard", F.pmod(own, F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInPandas(fill, f"key {kind}, {PIECES}, sequence_id bigint, offset bigint").withColumnRenamed("key", key)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pack(cut(tokenize(docs, "doc_id", "text"), "pieces"), "doc_id")
