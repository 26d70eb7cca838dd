"""Rows that repeat an id and a text: work in line with the rows, the same results."""

import random
import time

import pytest
from pyspark.sql import functions as F

from quire.llm import simhash, substrings, suffixes, toxicity
from tests.llm import brute

MANY = 10_000


def copies(spark, texts, n):
    """n rows of each (id, text), over several partitions."""
    rows = spark.createDataFrame(list(texts), "doc_id long, text string")
    return rows.join(spark.range(n).select(F.col("id").alias("copy")).repartition(4))


def prose(seed, n):
    r = random.Random(seed)
    return [f"w{r.randrange(5000)}" for _ in range(n)]


def test_near_dedup_joins_a_row_a_node(spark, monkeypatch):
    base = prose(1, 200)
    near = [*base[:199], "other"]
    spaced = "  ".join(base)  # another text of the same id with the same shingles
    docs = copies(spark, [(1, " ".join(base)), (2, " ".join(near)), (1, spaced), (3, " ".join(prose(2, 200)))], MANY)
    seen = []
    verified = simhash._verified

    def counting(shared, pairs, similarity):
        seen.append((shared.count(), pairs.count()))
        return verified(shared, pairs, similarity)

    monkeypatch.setattr(simhash, "_verified", counting)
    kept = simhash.keep_one(docs, "doc_id", "text")
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]
    assert kept.columns == docs.columns
    assert seen and all(shared == 2 and pairs <= 1 for shared, pairs in seen)


@pytest.mark.parametrize("bits", [12, 17])
def test_number_of_parts_changes_nothing(spark, monkeypatch, bits):
    monkeypatch.setattr(simhash, "FEWEST", bits)
    r = random.Random(3)
    base = [prose(k, 60) for k in range(5)]
    docs = [(i, " ".join(w if r.random() > 0.02 else "x" for w in base[i % 5])) for i in range(60)]
    got = {x.node: x.root for x in simhash.similar_groups(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text").collect()}
    sets = {i: set(zip(*(t.split()[k:] for k in range(5)), strict=False)) for i, t in docs}
    want = brute.components([i for i, _ in docs], lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9)
    first = {}
    for i in sorted(sets):
        first.setdefault(frozenset(sets[i]), i)
    assert got == {i: want[i] for i in first.values()}


@pytest.mark.parametrize(("module", "n"), [(substrings, "n_words"), (suffixes, "n_bytes")])
def test_substrings_of_repeated_rows(spark, module, n):
    base = prose(4, 400)
    texts = [(1, " ".join(base)), (2, " ".join(prose(5, 30) + base[100:200]))]
    seconds = []
    for k in (MANY // 10, MANY):
        began = time.time()
        got = module.removal_digest(copies(spark, texts, k).select("doc_id", "text"), "doc_id", "text").groupBy("doc_id", n, "n_removed").count().collect()
        seconds.append(time.time() - began)
        assert sorted(r.doc_id for r in got) == [1, 2] and all(r["count"] == k for r in got)
        removed = {r.doc_id: r.n_removed for r in got}
        assert removed[1] == 0 and removed[2] >= 100
    assert seconds[1] < 5 * max(seconds[0], 3)  # ten times the rows


def test_toxicity_collects_a_text_a_key(spark, monkeypatch):
    sizes = []
    fit = toxicity.fit_chain
    monkeypatch.setattr(toxicity, "fit_chain", lambda rows, *a, **k: sizes.append([len(rows), max(map(len, rows))]) or fit(rows, *a, **k))
    texts = [(i, " ".join(prose(i, 30) + ["nasty"] * (i % 2))) for i in range(40)]
    docs = copies(spark, [(0, texts[1][1])], MANY).select("doc_id", "text").unionByName(spark.createDataFrame(texts, "doc_id long, text string"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(0, 1)] * 50, "`key``.` long, bad int")
    named = docs.select(F.col("doc_id").alias("key`."), F.col("text").alias("t`ext"))
    chain = toxicity.train(named, labels, "key`.", "t`ext", {"bad": "bad = 1"}, sample=30)
    assert chain is not None and sizes[0][0] == 30 and sizes[0][1] <= toxicity.WIDEST
    monkeypatch.setattr(toxicity, "WIDEST", 7)
    toxicity.train(named, labels, "key`.", "t`ext", {"bad": "bad = 1"}, sample=30)
    assert sizes[1] == [30, 7]
