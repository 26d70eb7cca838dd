"""A corpus pipeline: language ID, SimHash near-dedup, substring dedup, secret scans, best-fit packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it as Parquet to the shared folder and reads
it again as the next stage's docs. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import cut, discard, scratch, scratch_path, table
from quire.llm.language import UNKNOWN, fit, held_out, identify
from quire.llm.packing import pack, tokenize
from quire.llm.secrets import redact
from quire.llm.simhash import keep_one
from quire.llm.substrings import remove_repeats


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told (no text, no letter) go; a missing lang becomes the predicted one."""
    model = fit(docs.filter(~held_out("doc_id")), "text", "lang")
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    told = identify(docs.select("text", F.struct(*others).alias("row_")), "text", model).filter(F.col("lang_pred") != UNKNOWN)
    kept = {"text": F.col("text"), "lang": F.coalesce("row_.lang", "lang_pred")}
    return told.select(*(kept.get(c, F.col("row_")[c]).alias(c) for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8 or more) the document with the smallest id stays. The anchors
    of SimHash fingerprints find the first links, a join of rare shingles the rest; each link is checked on the sets of shingles."""
    return keep_one(docs, "doc_id", "text", 5, 0.8)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 20 words or more that also start earlier go; a document that loses all its words goes with them."""
    left = remove_repeats(docs, "doc_id", "text")
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the text are replaced by a mark."""
    clean = redact(docs, "doc_id", "text", scratch_path(spark, "ledger"))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences of 2048 tokens."""
    return pack(cut(tokenize(docs, "doc_id", "text"), "pieces"), "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("secret_scans", secret_scan),
    ("best_fit_packing", packing),
]

#: Recompression names, language inference and tokenization have no SQL; tests hold each stage against a plain version on what the one before it kept.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; a stage's own tables and its predecessor's result are deleted once its result is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch() as keep:
            after = keep(cut(stage(spark, docs, sf_dir), name))
        discard(docs)
        docs = after
    return docs
