"""Language identification as inference in a multilingual mixture.

Each word comes from one language, with the likelihood of its character trigrams there; expectation-maximisation
estimates every language's share of a document, and all learned languages enter. Languages leave the mixture as long as the
likelihood drops by less than a penalty: first all that hold less than a word, if they can go together, then one by one, the
smallest share first. The largest share of those that stay is the prediction.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quire.llm.common import columns, map_rows, place, quoted, small_batches, table

#: Trigram buckets; the model has one number for each bucket and language.
BUCKETS = 1 << 16
#: Added to every count.
SMOOTHING = 0.5
#: Documents inferred together, and rounds of expectation-maximisation for each set.
DOCS, ROUNDS = 512, 5
#: Nats that a further language must gain: a part for each word (likelihoods of single words are noisy) and a multiple of log(words).
PER_WORD, PER_LOG = 0.15, 1.0
UNKNOWN = "und"
_WORDS = re.compile(r"[^\W\d_]+")


def words(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def has_letter(found: list[str]) -> bool:
    return any(c.isalpha() for w in found for c in w)


def trigrams(found: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words' trigrams, words padded by one space on each side, and where each word's begin."""
    text = " " + " ".join(found) + " "
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    gram = (code[:-2] * np.uint64(0x9E3779B1) + code[1:-1]) * np.uint64(0x85EBCA77) + code[2:]
    gram = (gram * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(48)
    # a word of n letters has n trigrams; those centred on the space between two words are left out
    length = np.fromiter(map(len, found), np.int64, len(found))
    begin = np.cumsum(length + 1) - (length + 1)
    keep = code[1:-1] != 32
    return gram[keep].astype(np.int64), begin - np.arange(len(found))


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen: dict[str, Counter] = {}
        for lang, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            seen.setdefault(lang, Counter()).update(words(x.as_py()))
        for lang, counter in seen.items():
            if not counter:
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([0], pa.int32()), pa.array([0], pa.int64())], ["lang", "bucket", "n"])
                continue
            found = [*counter]
            gram, begin = trigrams(found)
            each = np.repeat(np.fromiter(counter.values(), np.int64, len(found)), np.diff(np.r_[begin, len(gram)]))
            total = np.bincount(gram, each, BUCKETS).astype(np.int64)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(total[at])], ["lang", "bucket", "n"])


class Model:
    """langs, and log-likelihoods of buckets (buckets, langs)."""

    def __init__(self, langs: list[str], logp: np.ndarray) -> None:
        self.langs, self.logp = langs, logp


def fit(rows: DataFrame, text: str, lang: str) -> Model:
    """Counts over all rows with a text and a language. What reaches the driver is BUCKETS numbers a language at most."""
    small_batches(rows.sparkSession)
    spoken, told = F.col(quoted(text)), F.col(quoted(lang))
    used = rows.filter(spoken.isNotNull() & told.isNotNull()).select(told.alias("lang"), spoken.alias("text"))
    counts = used.mapInArrow(_train, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counts.lang.unique())
    n = np.full((BUCKETS, len(langs)), SMOOTHING)
    if langs:
        np.add.at(n, (counts.bucket.to_numpy(), np.searchsorted(langs, counts.lang)), counts.n.to_numpy())
    return Model(langs, np.log(n / n.sum(axis=0)).astype(np.float32))


def _mixture(p: np.ndarray, count: np.ndarray, doc: np.ndarray, ptr: np.ndarray, share: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Shares after some rounds, and the log-likelihood (of p) at the shares before the last."""
    n = np.add.reduceat(count, ptr)
    for _ in range(rounds):
        part = p * share[doc]
        whole = part.sum(axis=1)
        part *= (count / whole)[:, None]
        share = np.add.reduceat(part, ptr, axis=0) / n[:, None]
    return share, np.add.reduceat(count * np.log(whole), ptr)


def infer(model: Model, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Shares (texts, langs) in the chosen sets of languages, and the shares of the whole mixture; every text has a word."""
    number: dict[str, int] = {}
    spelled = [np.fromiter((number.setdefault(w, len(number)) for w in t), np.int64, len(t)) for t in texts]
    gram, begin = trigrams([*number])
    by_word = np.add.reduceat(model.logp[gram], begin, axis=0).astype(np.float64)
    pairs = [np.unique(s, return_counts=True) for s in spelled]
    word, count = np.concatenate([a for a, _ in pairs]), np.concatenate([b for _, b in pairs]).astype(np.float64)
    size = np.array([len(a) for a, _ in pairs])
    ptr, doc = np.cumsum(size) - size, np.repeat(np.arange(len(texts)), size)
    logp = by_word[word]
    p = np.exp(np.maximum(logp - logp.max(axis=1, keepdims=True), -60))
    n = np.add.reduceat(count, ptr)
    langs = len(model.langs)
    mask = np.ones((len(texts), langs), bool)
    share, _ = _mixture(p, count, doc, ptr, mask / langs, ROUNDS)
    whole = share
    penalty = PER_LOG * np.log(n + 1) + PER_WORD * n
    share, fit_ = _mixture(p, count, doc, ptr, share, 1)

    def without(fewer: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """Where asked, take the smaller set if it costs less than the penalty; says where it was taken."""
        start = np.where(fewer, np.maximum(share, 1e-3), 0)
        start /= start.sum(axis=1, keepdims=True)
        less, fit_less = _mixture(p, count, doc, ptr, start, ROUNDS)
        drop = asked & (fit_ - fit_less < penalty)
        mask[drop], share[drop], fit_[drop] = fewer[drop], less[drop], fit_less[drop]
        return drop

    idle = share * n[:, None] < 1
    idle[np.arange(len(texts)), share.argmax(axis=1)] = False
    if langs > 2 and (idle.sum(axis=1) > 1).any():
        without(~idle, idle.any(axis=1))
    going = mask.sum(axis=1) > 1
    while going.any():
        weakest = np.where(mask, share, np.inf).argmin(axis=1)
        fewer = mask.copy()
        fewer[np.flatnonzero(going), weakest[going]] = False
        going = without(fewer, going) & (mask.sum(axis=1) > 1)
    return np.where(mask, share, 0), whole


def identify(docs: DataFrame, text: str, model: Model) -> DataFrame:
    """docs with lang_pred, score (its share of the whole mixture, drawn towards an even one by few words) and languages, a map of
    the chosen set's shares. Texts that are null or without a letter are `und` with score 0 and an empty map, and so is
    every text if the model has no language. No column is used but text; repeated rows get equal results. Columns of docs
    with one of the new names are replaced."""
    small_batches(docs.sparkSession)
    docs = docs.select(*columns(c for c in docs.columns if c.lower() not in ("lang_pred", "score", "languages")))
    langs, at = model.langs, place(docs, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, DOCS):
                part = batch.slice(i, DOCS)
                spoken = [words(x or "") for x in part.column(at).to_pylist()]
                pred, score = [UNKNOWN] * part.num_rows, [0.0] * part.num_rows
                sets: list[list[tuple[str, float]]] = [[] for _ in pred]
                use = [j for j, w in enumerate(spoken) if langs and has_letter(w)]
                if use:
                    chosen, whole = infer(model, [spoken[j] for j in use])
                    for j, c, h in zip(use, chosen, whole, strict=True):
                        best = int(c.argmax())
                        n = len(spoken[j])
                        pred[j], score[j] = langs[best], float((h[best] * n + 1) / (n + len(langs)))
                        sets[j] = [(langs[k], float(c[k])) for k in np.flatnonzero(c)]
                extra = [pa.array(pred), pa.array(score, pa.float64()), pa.array(sets, pa.map_(pa.string(), pa.float64()))]
                yield pa.RecordBatch.from_arrays([*part.columns, *extra], [*part.schema.names, "lang_pred", "score", "languages"])

    return map_rows(docs, run, StructType.fromDDL("lang_pred string, score double, languages map<string,double>"))


def held_out(key: str) -> Column:
    """Whether a document is kept from training: crc32 of its id as text leaves 2 modulo 4 (a null id: not)."""
    return F.coalesce(F.crc32(F.col(quoted(key)).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op7_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.filter(~held_out("doc_id")), "text", "lang")
    return identify(docs.select("doc_id", "text"), "text", model).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
