"""Operators 11 to 13 against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import exponion, importance, products
from quire.llm.queries import QUERIES
from quire.llm.sql import SQL

EXTRA = "v array<double>, id string, dim string, h string, cell int, shared string, score string, row_ string, x string, code string, c0 int, `a.b` int, rank string"


def plain_products(rows, asked, k, scale):
    whole = lambda v: tuple(math.floor(scale * c) for c in v)
    good = lambda v: v is not None and all(c is not None and math.isfinite(c) for c in v)
    base = {(i, whole(v)) for i, v in rows if i is not None and good(v)}
    out = []
    for q, x in {(i, whole(v)) for i, v in asked if i is not None and good(v)}:
        found = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in base if i != q and len(x) == len(y))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:k])]
    return sorted(out)


def vectors(seed, n=600, dim=8):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(6, dim))
    rows = [(int(i), [float(c) for c in centres[i % 6] + r.normal(size=dim) * 0.2]) for i in range(n)]
    rows += [(n + i, rows[7][1]) for i in range(200)]  # copies of one vector
    rows += [rows[3]] * 50 + [(3, rows[9][1])]  # repeated rows, and another vector of the same id
    rows += [(9000, None), (9001, [None] * dim), (9002, [float("nan")] * dim), (9003, [float("inf")] * dim), (9004, [0.0] * dim), (9005, [1.0, 2.0]), (9006, [3.0, -1.0]), (9007, []), (None, rows[1][1])]
    return rows


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, [1.0], "i", "d", "h", 1, "s", "q", "r", "x", "c", 2, 3, "k") for i, v in rows], f"vec_id long, embedding array<double>, {EXTRA}")


@pytest.mark.parametrize(("most", "block", "leaf"), [(16_384, 32_768, 64), (100, 7, 4)])
def test_exact_products(spark, monkeypatch, most, block, leaf):
    for name, value in (("MOST", most), ("BLOCK", block), ("LEAF", leaf), ("BATCH", 5)):
        monkeypatch.setattr(products, name, value)
    rows = vectors(1)
    asked = [(i, v) for i, v in rows if i is not None and (i % 20 == 0 or i in (3, 9004, 9006, 9007) or i > 9000)]
    got = products.top_products(table_of(spark, rows), table_of(spark, asked), "vec_id", "embedding", 4, 16)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()) == plain_products(rows, asked, 4, 16)


def test_products_of_few_and_no_rows(spark):
    one = table_of(spark, [(1, [1.0, 2.0]), (2, [0.5, 0.5])])
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in products.top_products(one, one.filter("vec_id = 1"), "vec_id", "embedding", 5, 2).collect()] == [(1, 1, 2, 6)]
    none = one.limit(0)
    for base, asked in ((none, one), (one, none), (none, none)):
        assert products.top_products(base, asked, "vec_id", "embedding").count() == 0
    odd = spark.createDataFrame([(1, [1.0])] * 3 + [(2, [-1.0])], "`we``ird.id` long, `v.x` array<float>")
    assert [(r[0], r[3], r[4]) for r in products.top_products(odd, odd.filter("`we``ird.id` = 1"), "we`ird.id", "v.x").collect()] == [(1, 2, -(256**2))]


def test_large_components_stay_exact_or_raise(spark):
    rows = [(1, [2.0**27 + 1, 1.0]), (2, [2.0**27 + 3, 3.0]), (3, [2.0**27 + 3, 2.0])]
    got = products.top_products(table_of(spark, rows), table_of(spark, rows[:1]), "vec_id", "embedding", 2, 1).collect()
    assert [(r.vec_id, r.score) for r in got] == [(i, (2**27 + 1) * (2**27 + 3) + j) for i, j in ((2, 3), (3, 2))]
    huge = table_of(spark, [(1, [1e30]), (2, [1e30])])
    with pytest.raises(Exception, match="too large"):
        products.top_products(huge, huge, "vec_id", "embedding")


def test_bounds_prune(spark):
    """On clustered vectors a query compares with few of a shard's vectors, and none when another shard's k-th score is out of reach."""
    r = np.random.default_rng(2)
    centres = r.normal(size=(40, 16)) * 100
    x = np.floor(centres[np.arange(8000) % 40] + r.normal(size=(8000, 16))).astype(np.int64)
    tree, q = products.build(x.astype(float)), x[:50]
    x = x[tree.order]
    search = products.Search(tree, tree.order, x, q, np.arange(50), np.full(50, products.LOWEST), 5)
    search.run()
    scores = q @ x.T
    for i in range(50):
        best = sorted((-int(s), int(j)) for s, j in zip(scores[i], tree.order, strict=True) if j != i)[:5]
        assert [(-s, j) for s, j in best] == list(zip(search.score[i].tolist(), search.found[i].tolist(), strict=True))
    assert search.compared < 50 * 8000 / 4
    again = products.Search(tree, tree.order, x, q, np.arange(50), np.full(50, 10**9), 5)
    again.run()
    assert again.compared == 0


def plain_codes(rows, parts, entries, rounds, scale):
    """rows: (key, label, vector). Per row (code, error), and the codebooks."""
    whole = [[math.floor(scale * c) for c in v] for _, _, v in rows]
    width = len(whole[0]) // parts
    first = {}
    for (key, _, _), x in zip(rows, whole, strict=True):
        if key is not None:
            first[key] = min(first.get(key, x), x)
    start = [first[k] for k in sorted(first)[:entries]]
    books = [[x[p * width : (p + 1) * width] for x in start] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(x[p * width : (p + 1) * width], e, strict=True)), j) for j, e in enumerate(books[p])) for p in range(parts)] for x in whole]

    for _ in range(rounds):
        near = assign()
        for p in range(parts):
            for j in range(len(books[p])):
                of = [x[p * width : (p + 1) * width] for x, n in zip(whole, near, strict=True) if n[p][1] == j]
                if of:
                    books[p][j] = [sum(c) // len(of) for c in zip(*of, strict=True)]
    return [("".join(f"{j:02x}" for _, j in n), sum(d for d, _ in n)) for n in assign()], books


@pytest.mark.parametrize(("step", "components"), [(32, 2**22), (3, 64)])
def test_codes_by_brute_force(spark, monkeypatch, step, components):
    monkeypatch.setattr(exponion, "STEP", step)
    monkeypatch.setattr(exponion, "COMPONENTS", components)
    r = random.Random(5)
    rows = [(r.randrange(40), r.choice((1, 2, None)), [r.choice((-0.5, 0.0, 0.25, 0.3)) + r.random() / 50 for _ in range(8)]) for _ in range(150)]
    rows += [rows[0]] * 30 + [(None, 3, rows[4][2])]  # repeated rows, ids with several vectors, a row without an id
    bad = [(0, 1, None), (1, 1, [None] * 8), (2, 1, [float("nan")] * 8), (3, 2, [float("-inf")] * 8), (4, 2, [1.0]), (50, 2, [1.0] * 12)]
    want, books = plain_codes(rows, 4, 20, 3, 64)
    df = spark.createDataFrame([(k, v, lab, "x") for k, lab, v in rows + bad], "`k.1` long, x array<double>, row_ int, code string")
    got = exponion.code_digest(df, "k.1", "x", "row_", parts=4, entries=20, rounds=3, scale=64).collect()
    sums = Counter()
    for (_, lab, _), (_, e) in zip(rows, want, strict=True):
        sums[lab] += e
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    said = sorted((k is None, k or 0, c, e, sums[lab], digest) for (k, lab, _), (c, e) in zip(rows, want, strict=True))
    assert sorted((x[0] is None, x[0] or 0, *x[1:]) for x in got) == said


def test_codes_of_few_rows(spark):
    df = spark.createDataFrame([(5, [1.0, 2.0, 3.0, 4.0], 1), (5, [0.0] * 4, 1)], "id long, v array<float>, label int")
    got = exponion.code_digest(df, "id", "v", "label").collect()
    assert [(r.id, r.code) for r in got] == [(5, "00000000")] * 2  # one start; the other vector moves it
    assert exponion.code_digest(df.limit(0), "id", "v", "label").count() == 0
    assert [r.code for r in exponion.code_digest(df.withColumn("v", F.array().cast("array<float>")), "id", "v", "label").collect()] == ["00000000"] * 2
    with pytest.raises(ValueError, match="equal parts"):
        exponion.code_digest(df.withColumn("v", F.array(F.lit(1.0))), "id", "v", "label")
    codes = exponion.learn(df, "id", "v", parts=2, entries=4, rounds=1, scale=4)
    assert [[v / 4 for v in b[0]] for b in codes.books] == [[0.5, 1.0], [1.5, 2.0]]
    assert [r.vector for r in exponion.decode(codes, 4).collect()] == [[0.5, 1.0, 1.5, 2.0]] * 2


def test_exponion_equals_a_full_scan():
    r = np.random.default_rng(8)
    for spread in (3, 10**6, 2**28):
        entries = r.integers(-spread, spread, (70, 5))
        entries[50:60] = entries[10:20]  # equal entries: the smaller index
        x = np.concatenate([r.integers(-spread, spread, (300, 5)), entries[::3]])
        book = exponion.Book(entries)
        found, best = book.nearest(x, r.integers(0, 70, len(x)))
        apart = ((x[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        assert found.tolist() == apart.argmin(axis=1).tolist() and best.tolist() == apart.min(axis=1).tolist()


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_features(text, longest, buckets):
    w = WORD.findall((text or "").translate(LOWER))
    return len(w), Counter(zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1))


@pytest.mark.parametrize("longest", [1, 2, 3, 5])
def test_ring_finds_all_runs(monkeypatch, longest):
    monkeypatch.setattr(importance, "BLOCK", 16)
    r = random.Random(longest)
    for _ in range(60):
        text = "".join(r.choice(("a", "Bc", "ß", "9", " ", "\n", "-", "É", "\x00", "中", "z" * r.choice((1, 40)))) for _ in range(r.randrange(120)))
        n, total = importance.scan(text.encode(), longest, 97)
        want, counts = plain_features(text, longest, 97)
        assert n == want and {int(b): int(total[b]) for b in np.flatnonzero(total)} == counts


def test_resampling_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(importance, "FEW", 7)
    r = random.Random(6)
    said = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(r.choice(said[: 10 + i % 50]) for _ in range(r.randrange(12)))) for i in range(160)]
    docs += [(200, None), (201, ""), (202, " -- "), (None, "w1 w2 w3 w4 w5 w6"), (None, None)] + [(7, "w3 w1 w4 w1 w5")] * 40  # one row 40 times
    target = ["w1 w2 w3", "w2 W3", None, ""]
    buckets = 50
    per = [plain_features(t, 2, buckets) for _, t in docs]
    s, t = sum((c for _, c in per), Counter()), sum((plain_features(x, 2, buckets)[1] for x in target), Counter())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s.values()) + buckets) / ((s[b] + 1) * (sum(t.values()) + buckets)))) for b in range(buckets)]
    want = []
    for (i, _), (n, c) in zip(docs, per, strict=True):
        m = sum(c.values())
        weight = sum(gain[b] * k for b, k in c.items()) // m if m else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        want.append((i, m, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= 4))
    fit = sorted((x for x in want if x[4]), key=lambda x: (-x[3], x[0] is not None, x[0] or 0))
    drawn = [(*x[:4], n + 1) for n, x in enumerate(fit[: 30 * len(fit) // 100])]
    rest = Counter(x[:4] for x in want) - Counter(x[:4] for x in drawn)
    df = spark.createDataFrame([(i, x, "w", 5, "b", 6) for i, x in docs], "doc_id long, text string, weight string, row_of_ int, bucket_ string, `a.b` int")
    wanted = spark.createDataFrame([(x, 1) for x in target], "text string, text_ int")
    got = importance.resample(df, "doc_id", "text", wanted, "text", 30, 4, 2, buckets)
    assert got.columns == ["doc_id", "row_of_", "bucket_", "a.b", "n_features", "weight", "score", "rank"]
    rows = [(x.doc_id, x.n_features, x.weight, x.score, x["rank"]) for x in got.collect()]
    assert sorted((x for x in rows if x[4]), key=lambda x: x[4]) == drawn
    assert Counter(x[:4] for x in rows if x[4] is None) == rest
    assert importance.resample(df.limit(0), "doc_id", "text", wanted, "text").count() == 0
    alone = importance.resample(df, "doc_id", "text", wanted.limit(0), "text", 100, 0).collect()
    assert sorted(x["rank"] for x in alone) == list(range(1, len(docs) + 1))


def test_long_texts_have_counts_of_bounded_size(spark):
    r = random.Random(9)
    text = " ".join(f"w{r.randrange(10**6)}" for _ in range(400_000))
    got = importance.counted(spark.createDataFrame([(1, text), (2, "x" * 3_000_000)], "doc_id long, text string"), "text").collect()
    assert got[0].words_ == 400_000 and len(got[0].bucket_) == 10_000 and sum(got[0].times_) == 799_999
    assert (got[1].words_, got[1].times_) == (1, [1])


@pytest.mark.parametrize("name", ["op11_ball_tree_search", "op12_exponion_codes", "op13_crc_ring_resampling"])
def test_new_queries_by_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df, rel = QUERIES[name](spark, sf), con.sql(SQL[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(repr, (tuple(r) for r in df.select(*names).collect()))) == sorted(map(repr, rel.fetchall()))


@pytest.mark.parametrize(("least", "block"), [(4096, 32_768), (40, 2)])
def test_neighbours_of_several_vectors_of_one_key(spark, monkeypatch, least, block):
    """Each has a list of its own, and both are found."""
    from quire.llm import neighbours

    monkeypatch.setattr(neighbours, "LEAST", least)
    monkeypatch.setattr(neighbours, "BLOCK", block)
    r = np.random.default_rng(3)
    rows = [(int(i), [float(v) for v in r.normal(size=4)]) for i in range(300)]
    rows += [(0, [5.0, 5.0, 5.0, 5.0]), (0, rows[0][1]), (7, [5.0, 5.0, 5.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>")
    got = {}
    for x in neighbours.nearest(df, df.filter("vec_id IN (0, 7)"), "vec_id", "v", 3, factor=1.0).collect():
        got.setdefault((x.query_id, x.query_hash), []).append((x["rank"], x.vec_id, round(x.score, 9)))
    want = []
    for q, v in {(i, tuple(v)) for i, v in rows if i in (0, 7)}:
        near = sorted((math.dist(v, w), i) for i, w in {(i, tuple(w)) for i, w in rows} if i != q)[:3]
        want.append((q, [(n + 1, i, round(d, 9)) for n, (d, i) in enumerate(near)]))
    assert sorted((q, sorted(found)) for (q, _), found in got.items()) == sorted(want)
