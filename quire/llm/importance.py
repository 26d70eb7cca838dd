"""Importance resampling towards a target distribution: documents are drawn by the ratio of hashed word-run counts in target and corpus.

One scan of a document finds the buckets of all runs of 1 to n words. A ring holds the zlib CRC states of the runs that began at the
last n words; the next word extends each by a space and itself, so no run is ever put together, and a text is read in blocks. The
scan's result, a document's counts by bucket, is written once; totals, gains and weights come from it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from quire.llm.common import cut, fresh, map_rows, quoted, scratch, small_batches, table

#: A-Z to a-z, digits and bytes of other letters as they are, anything else to a space.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Bytes of a text that are cut into words at once, and documents of a result batch.
BLOCK = 2**20
FEW = 256


def words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, lower-cased, by blocks."""
    at = 0
    while at < len(text):
        part = text[at : at + BLOCK].translate(WORD_BYTES)
        at += len(part)
        if at < len(text):
            # what may be the beginning of a word goes to the next block; a word longer than a block stays whole
            end = part.rfind(b" ") + 1
            while not end and at < len(text):
                more = text[at : at + len(part)].translate(WORD_BYTES)
                end = len(part) + more.rfind(b" ") + 1 if b" " in more else 0
                part, at = part + more, at + len(more)
            if at < len(text):
                at -= len(part) - end
                part = part[:end]
        yield part.split()


def scan(text: bytes, longest: int, buckets: int) -> tuple[int, np.ndarray]:
    """(words, the bucket of each run of 1 to longest words, counted)."""
    total, n = np.zeros(buckets, np.int64), 0
    ring: list[int] = []
    for block in words(text):
        out = []
        add = out.append
        if longest == 2:  # the ring has one state
            before = ring[0] if ring else None
            for w in block:
                if before is not None:
                    add(crc32(w, crc32(b" ", before)))
                before = crc32(w)
                add(before)
            ring = [] if before is None else [before]
        else:
            for w in block:
                ring = [crc32(w, crc32(b" ", state)) for state in ring]
                ring.append(crc32(w))
                out += ring
                if len(ring) == longest:
                    del ring[0]
        n += len(block)
        total += np.bincount(np.array(out, np.uint32) % buckets, minlength=buckets)
    return n, total


COUNTED = StructType([StructField("words_", LongType()), StructField("bucket_", ArrayType(IntegerType())), StructField("times_", ArrayType(LongType()))])


def counted(docs: DataFrame, text: str, longest: int = 2, buckets: int = 10_000) -> DataFrame:
    """docs without the text, with words_, bucket_ (those that it has, ascending) and times_: at most as many as there are buckets,
    however long the text. A null text has none."""
    small_batches(docs.sparkSession)
    rest = [c for c in docs.columns if c != text]
    plain = docs.select(*(F.col(quoted(c)) for c in rest), F.col(quoted(text)).cast("binary").alias(fresh(docs, "text_")))
    last = len(rest)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, FEW) for b in it for at in range(0, len(b), FEW)):
            n_words, sizes, found, times = [], [0], [], []
            for t in batch.column(last):
                n, total = scan(t.as_py() or b"", longest, buckets)
                has = np.flatnonzero(total)
                n_words.append(n)
                found.append(has)
                times.append(total[has])
                sizes.append(len(has))
            ends = pa.array(np.cumsum(sizes), pa.int32())
            flat = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (found, times)]
            lists = [pa.ListArray.from_arrays(ends, pa.array(v, t)) for v, t in zip(flat, (pa.int32(), pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n_words, pa.int64()), *lists], names=[*batch.schema.names, *COUNTED.names])

    return map_rows(plain, run, COUNTED).drop(plain.columns[last])


def totals(rows: DataFrame, buckets: int) -> np.ndarray:
    """Times of each bucket over all rows; tasks add up their own rows, and the driver gets a row a bucket."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in it:
            np.add.at(total, batch.column(0).flatten().to_numpy(), batch.column(1).flatten().to_numpy())
        has = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(has, pa.int32()), pa.array(total[has], pa.int64())], names=["bucket", "times"])

    out = np.zeros(buckets, np.int64)
    for r in rows.select("bucket_", "times_").mapInArrow(run, "bucket int, times long").groupBy("bucket").agg(F.sum("times").alias("times")).collect():
        out[r.bucket] = r.times
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share of the target over that of the source."""
    n, s, t = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(float(b + 1) * float(s + n) / (float(a + 1) * float(t + n)))) for a, b in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weighed(rows: DataFrame, gain: np.ndarray) -> DataFrame:
    """counted() rows with n_features and weight (the floored mean gain of the features; none: 0) in place of their counts."""
    made = StructType([StructField("n_features_", LongType()), StructField("weight_", LongType())])
    at = [rows.columns.index(c) for c in ("bucket_", "times_")]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            bucket, times = (batch.column(i) for i in at)
            ends = np.r_[0, np.cumsum(bucket.value_lengths().to_numpy())].astype(np.int64)
            times = times.flatten().to_numpy()
            value = gain[bucket.flatten().to_numpy()] * times
            n, s = (np.r_[0, np.cumsum(v)][ends] for v in (times, value))
            n, s = np.diff(n), np.diff(s)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n), pa.array(s // np.maximum(n, 1))], names=[*batch.schema.names, *made.names])

    return map_rows(rows, run, made).drop("bucket_", "times_")


def noise(key: Column, seed: int) -> Column:
    """A key's fixed draw from the standard Gumbel distribution, times 1000, floored; a null key counts as an empty one."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def ranked(rows: DataFrame, size: int) -> DataFrame:
    """rows (id_, score_, ...) with rank_: 1, 2, ... for the size highest scores, ties to the smaller id (null first), null for the rest.

    No task sorts more than its share: the score that the last one drawn has comes from counts by score, whose number has a bound
    (weights and draws are logarithms of counts and hashes); what reaches it is dealt over ranges of (score, id, row), so that rows
    repeated without end still part, and a range's ranks start behind the counts of those before it."""
    counts = sorted(((r.score_, r["count"]) for r in rows.filter("fit_").groupBy("score_").count().collect()), reverse=True)
    least, above = None, 0
    for score, n in counts:
        if above >= size:
            break
        least, above = score, above + n
    none = F.lit(None).cast("long")
    if least is None:
        return rows.withColumn("rank_", none)
    reach = F.col("fit_") & (F.col("score_") >= F.lit(least))
    order = [F.col("score_").desc(), F.col("id_").asc_nulls_first(), F.col("row_")]
    dealt = rows.filter(reach).withColumn("row_", F.monotonically_increasing_id()).repartitionByRange(*order)
    part = cut(dealt.withColumn("range_", F.spark_partition_id()), "ranges")
    before = Window.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    first = part.groupBy("range_").count().select("range_", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first_"))
    number = F.row_number().over(Window.partitionBy("range_").orderBy(*order)) + F.col("first_")
    drawn = part.join(F.broadcast(first), "range_").withColumn("rank_", number.cast("long"))
    drawn = drawn.withColumn("rank_", F.when(F.col("rank_") <= size, F.col("rank_"))).select(*rows.columns, "rank_")
    return drawn.unionByName(rows.filter(~reach).withColumn("rank_", none))


def resample(docs: DataFrame, key: str, text: str, target: DataFrame, target_text: str, share: int = 25, least: int = 20, longest: int = 2, buckets: int = 10_000, seed: int = 7) -> DataFrame:
    """docs without the text, with n_features, weight, score and rank: of the documents of so many words at least, share per cent
    are drawn without replacement, those of the highest score = weight + Gumbel noise.

    Each row is a document: repeated rows count in the corpus and are ranked each, one behind the other. A null or empty text has no
    features and weight 0, a null key the noise of an empty one. Columns of docs that are called as a result are replaced; other names
    may be any. Without documents the result is empty, without a target all shares of the target are equal."""
    kept = [c for c in docs.columns if c != text and c.lower() not in ("n_features", "weight", "score", "rank") or c == key]
    plain = docs.select(F.struct(*(F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(kept))).alias("row_of_"), F.col(quoted(key)).alias("id_"), F.col(quoted(text)).alias("text_"))
    with scratch() as keep:
        rows = cut(counted(plain, "text_", longest, buckets), "counted")
        gain = gains(totals(rows, buckets), totals(counted(target.select(F.col(quoted(target_text)).alias("text_")), "text_", longest, buckets), buckets))
        scored = weighed(rows, gain).withColumn("score_", F.col("weight_") + noise(F.col("id_"), seed)).withColumn("fit_", F.col("words_") >= least)
        scored = cut(scored, "scored")
        size = scored.filter("fit_").count() * share // 100
        out = ranked(scored, size)
        back = [F.col(f"row_of_.c{i}").alias(c) for i, c in enumerate(kept)]
        named = [F.col(f"{c}_").alias(c) for c in ("n_features", "weight", "score", "rank")]
        return keep(cut(out.select(*back, *named), "resampled"))


def op13_crc_ring_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resample(docs, "doc_id", "text", table(spark, sf_dir, "benchmark"), "text")
