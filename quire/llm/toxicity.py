"""Toxicity by a classifier chain of linear models.

The chain's categories are learned one after another. A later model sees the words of a text, a few figures of its style,
and the earlier categories' probabilities. For training these come out of fold, from models that have not seen the
document; when the chain predicts, they come from the earlier models themselves.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quire.llm.common import columns, map_rows, place, quoted, small_batches, table
from quire.llm.language import held_out

#: Labelled documents that the chain is fitted on at most, those of least hash; features that a model knows; folds.
SAMPLE, KNOWN, FOLDS = 5_000, 400, 4
#: Documents of the sample that a feature must be in, and features that a document of the sample gives at most, those of least number.
SEEN, WIDEST = 5, 16_384
#: Weight of the squared coefficients, and steps of accelerated gradient descent.
RIDGE, STEPS = 1e-4, 400
#: Word beginnings that are features, in characters.
STEMS = (3, 4, 5, 6, 7)
_TOKENS = re.compile(r"\w+|[^\w\s]{2,}")
STYLE = 5
_CLASSES = np.array([4 if c.isspace() else 3 if c.isdigit() else 2 if c.isupper() else 1 if c.isalpha() else 0 for c in map(chr, range(0x3000))], np.uint8)


def features(text: str) -> set[int]:
    """CRC-32 numbers of the distinct lower-cased words, of their beginnings, and of runs of signs."""
    crc = zlib.crc32
    words = {w.encode("utf-32-le") for w in _TOKENS.findall(text.lower())}
    out = set(map(crc, words))
    for n in STEMS:
        out.update(map(crc, {b"^" + w[: 4 * n] for w in words if len(w) > 4 * n}))
    return out


def style(text: str) -> tuple[float, ...]:
    """Shares of capitals, digits, signs and distinct words, and the length's logarithm, each about 0 to 1."""
    n = max(1, len(text))
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    signs, small, capital, digit, _ = np.bincount(_CLASSES[np.minimum(code, 0x2FFF)], minlength=5).tolist()
    spoken = text.split()
    return (capital / max(1, small + capital), digit / n, signs / n, len(set(spoken)) / max(1, len(spoken)), float(np.log1p(n)) / 12)


@dataclass
class Linear:
    """A logistic model of known features, style figures and earlier probabilities. columns: a feature's number to its column."""

    category: str
    columns: dict[int, int]
    weights: np.ndarray
    threshold: float = 0.5

    def matrix(self, rows: Sequence[set[int]], more: np.ndarray) -> np.ndarray:
        x = np.zeros((len(rows), len(self.columns) + more.shape[1] + 1), np.float32)
        names, at = self.columns.keys(), self.columns
        for i, r in enumerate(rows):
            x[i, [at[f] for f in names & r]] = 1
        x[:, len(names) : -1] = more
        x[:, -1] = 1
        return x

    def predict(self, rows: Sequence[set[int]], more: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.matrix(rows, more) @ self.weights, -30, 30)))


class Sample:
    """Rows of a training sample: features as column numbers in one array, those in fewer than SEEN rows left out."""

    def __init__(self, rows: Sequence[np.ndarray]) -> None:
        flat = np.concatenate(rows) if len(rows) else np.empty(0, np.uint32)
        self.names, counts = np.unique(flat, return_counts=True)
        self.names = self.names[counts >= SEEN]
        size = np.fromiter(map(len, rows), np.int64, len(rows))
        at = np.searchsorted(self.names, flat)
        known = (at < len(self.names)) & (self.names[np.minimum(at, max(0, len(self.names) - 1))] == flat) if len(self.names) else np.zeros(len(flat), bool)
        self.column, self.row, self.size = at[known].astype(np.int32), np.repeat(np.arange(len(rows)), size)[known].astype(np.int32), len(rows)

    def fit(self, category: str, more: np.ndarray, y: np.ndarray, use: np.ndarray) -> tuple[Linear, np.ndarray]:
        """A model fitted on the rows in use (a mask), and its probabilities for all rows."""
        inside = use[self.row]
        every = np.bincount(self.column[inside], minlength=len(self.names))
        pos = np.bincount(self.column[inside], y[self.row[inside]], len(self.names))
        n, p = max(1, int(use.sum())), float(y[use].mean()) if use.any() else 0.0
        score = np.abs(pos - every * p) / np.sqrt(every * p * (1 - p) * np.maximum(1 - every / n, 1e-9) + 1)
        chosen = np.sort(np.argsort(-score, kind="stable")[:KNOWN])
        place = np.full(len(self.names) + 1, -1)
        place[chosen] = np.arange(len(chosen))
        x = np.zeros((self.size, len(chosen) + more.shape[1] + 1), np.float32)
        hit = place[self.column] >= 0
        x[self.row[hit], place[self.column[hit]]] = 1
        x[:, len(chosen) : -1] = more
        x[:, -1] = 1
        weights = logistic(x[use], y[use])
        model = Linear(category, {int(f): i for i, f in enumerate(self.names[chosen])}, weights)
        return model, 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression (the last column, the intercept, without ridge) by accelerated gradient descent."""
    n = max(1, len(y))
    v = np.ones(x.shape[1], np.float32)
    top = 1.0
    for _ in range(12):  # the largest eigenvalue of x'x / n, for the step
        v = x.T @ (x @ v) / n
        top = max(1e-6, float(np.linalg.norm(v)))
        v = v / top
    step = 1 / (0.3 * top + RIDGE)
    ridge = np.full(x.shape[1], RIDGE, np.float32)
    ridge[-1] = 0
    w = v = np.zeros(x.shape[1], np.float32)
    for k in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        new = v - step * (x.T @ (p - y).astype(np.float32) / n + ridge * v)
        w, v = new, new + k / (k + 3) * (new - w)
    return w


@dataclass
class Chain:
    models: list[Linear]

    def predict(self, texts: Sequence[str]) -> np.ndarray:
        """Probabilities (texts, categories)."""
        rows, more = [features(t) for t in texts], np.array([style(t) for t in texts]).reshape(len(texts), STYLE)
        out = np.zeros((len(texts), 0))
        for m in self.models:
            out = np.column_stack([out, m.predict(rows, np.column_stack([more, out]))])
        return out


def fit_chain(rows: Sequence[np.ndarray], more: np.ndarray, labels: dict[str, np.ndarray], folds: int = FOLDS) -> Chain:
    """The chain over labels' categories in their order. rows: arrays of distinct features. Row i is in fold i mod folds."""
    sample, models, fold = Sample(rows), [], np.arange(len(rows)) % folds
    for category, y in labels.items():
        y = np.asarray(y, float)
        out = np.zeros(len(rows))
        for k in range(folds):
            if (fold != k).any():
                out[fold == k] = sample.fit(category, more, y, fold != k)[1][fold == k]
        model, _ = sample.fit(category, more, y, np.ones(len(rows), bool))
        model.threshold = _threshold(out, y)
        models.append(model)
        more = np.column_stack([more, out])
    return Chain(models)


def _threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The cut with the best F1 out of fold, halfway to the next probability; 0.5 if there is no positive."""
    if not y.any():
        return 0.5
    order = np.argsort(-p, kind="stable")
    hit = np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(y) + 1) + y.sum())
    at = int(f1.argmax())
    below = p[order[at + 1]] if at + 1 < len(y) else 0.0
    return float(np.clip((p[order[at]] + below) / 2, 0.05, 0.95))


def train(docs: DataFrame, labels: DataFrame, key: str, text: str, categories: dict[str, str], sample: int = SAMPLE) -> Chain | None:
    """A chain for categories (name: SQL condition on a label row). The sample is bounded; None if no row has labels and a text.

    Label rows with a null are left out; of several rows for one key each category takes the largest value. Of several texts of one
    key the one of least hash is the sample's, so what the driver gets is `sample` texts at most, each of WIDEST features.
    """
    small_batches(docs.sparkSession)
    named = labels.select(F.col(quoted(key)).alias("key"), *(F.expr(c).cast("int").alias(f"y{i}") for i, c in enumerate(categories.values()))).na.drop()
    named = named.groupBy("key").agg(*(F.max(f"y{i}").alias(f"y{i}") for i in range(len(categories))))
    chosen = named.orderBy(F.xxhash64("key"), "key").limit(sample)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [np.sort(np.fromiter(features(t), np.uint32))[:WIDEST].view(np.int32) for t in texts]
            cols = [pa.array(found, pa.list_(pa.int32())), pa.array([list(style(t)) for t in texts], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], ["key", "tokens", "style"])

    plain = docs.select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).alias("text")).filter(F.col("text").isNotNull())
    # at most `sample` label rows are sent to the documents, so the broadcast is bounded
    held = plain.join(F.broadcast(chosen.select("key")), "key", "left_semi")
    held = held.groupBy("key").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one")).select("key", "one.text")
    kind = plain.schema["key"].dataType.simpleString()
    got = held.mapInArrow(gather, f"key {kind}, tokens array<int>, style array<double>").toPandas().sort_values("key")
    if not len(got):
        return None
    truth = chosen.toPandas().set_index("key").loc[got.key]
    return fit_chain([np.asarray(t, np.int32).view(np.uint32) for t in got.tokens], np.array(got["style"].tolist()), {c: truth[f"y{i}"].to_numpy(float) for i, c in enumerate(categories)})


def score(docs: DataFrame, text: str, chain: Chain | None) -> DataFrame:
    """docs with p_<category> and is_<category> (the probability reaches the category's threshold) for every category.
    Null text counts as empty; without a chain docs come back as they are. One pass, no shuffle; columns of docs with one of the
    new names are replaced."""
    models = chain.models if chain else []
    new = {f"{x}_{m.category}".lower() for m in models for x in ("p", "is")}
    docs = docs.select(*columns(c for c in docs.columns if c.lower() not in new))
    if not models:
        return docs
    at = place(docs, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                p = chain.predict([t or "" for t in part.column(at).to_pylist()])
                cols, names = [*part.columns], [*part.schema.names]
                for k, m in enumerate(models):
                    cols += [pa.array(p[:, k]), pa.array(p[:, k] >= m.threshold)]
                    names += [f"p_{m.category}", f"is_{m.category}"]
                yield pa.RecordBatch.from_arrays(cols, names)

    more = StructType()
    for m in models:
        more = more.add(f"p_{m.category}", "double").add(f"is_{m.category}", "boolean")
    return map_rows(docs, run, more)


CATEGORIES = {"poor": "quality = 0", "toxic": "toxic = 1"}


def op10_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    chain = train(docs.filter(~held_out("doc_id")), labels.filter(~held_out("doc_id")), "doc_id", "text", CATEGORIES)
    scored = score(docs.select("doc_id", "text"), "text", chain)
    if chain is None:
        scored = scored.selectExpr("*", "CAST(NULL AS double) AS p_toxic", "CAST(NULL AS boolean) AS is_toxic", "CAST(NULL AS double) AS p_poor")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), F.col("is_toxic").cast("int").alias("toxic"), F.col("p_toxic").alias("score"), F.col("p_poor").alias("poor_score"))
