"""Ordered scans equal windows, and their tasks stay small when one group grows."""

import random

import pytest
from pyspark.sql import functions as F

from quire.operators import order, scan

COLUMNS = "g string, o int, id int, v int, d decimal(10,2), n int"
WHATS = {"last_v": ("last", "v"), "next_v": ("next", "v"), "before_v": ("before", "v"), "after_v": ("after", "v"), "sum_v": ("total", "v"), "sum_d": ("total", "d"), "n": ("number", None)}


def scans():
    return {k: scan.Scan(what, c and F.col(c)) for k, (what, c) in WHATS.items()}


def rows_of(spark, n, seed=1):
    from decimal import Decimal

    r = random.Random(seed)
    out = []
    for i in range(n):
        g = r.choice(("hot", "hot", "hot", None, None, f"g{r.randrange(20)}"))
        out.append((g, r.choice((None, r.randrange(40))), i, r.choice((None, None, r.randrange(9))), Decimal(r.randrange(1000)) / 100, 0))
    return spark.createDataFrame(out, COLUMNS).repartition(5)


@pytest.mark.parametrize(("limit", "groups"), [(10**9, 10), (50, 100_000), (7, 100_000), (1, 3)])
def test_scans_equal_windows(spark, monkeypatch, limit, groups):
    df = rows_of(spark, 900)
    want = sorted(map(repr, scan.ordered(df, ["g"], ["o", "id"], scans()).collect()))
    monkeypatch.setattr(scan, "ROWS", limit)
    monkeypatch.setattr(scan, "GROUPS", groups)
    got = scan.ordered(df, ["g"], ["o", "id"], scans())
    assert got.columns == ["g", "o", "id", "v", "d", *WHATS]
    assert sorted(map(repr, got.collect())) == want
    alone = scan.ordered(df, [], ["o", "id"], {"n": scan.Scan("number")}).orderBy("n").select("n", "o", "id").collect()
    assert [x.n for x in alone] == list(range(1, 901)) and [(x.o is not None, x.o or 0, x.id) for x in alone] == sorted((x.o is not None, x.o or 0, x.id) for x in alone)
    assert scan.ordered(df.limit(0), ["g"], ["o"], scans()).count() == 0


def test_operators_over_one_large_group(spark, monkeypatch):
    df = rows_of(spark, 700, 2).withColumn("num", F.col("id") % 5)
    runs = {
        "sessions": lambda: order.sessions(df, F.col("v") == 3, ["g"], ["id"], "s"),
        "islands": lambda: order.islands(df, "v", ["g"], ["id"], "run"),
        "preceding": lambda: order.latest_preceding(df, F.col("v"), ["g"], ["id"], "p"),
        "following": lambda: order.next_following(df, F.col("v"), ["g"], ["id"], "f"),
        "findings": lambda: order.sequence_findings(df, "num", ["g"], ["id"], 0),
        "balance": lambda: order.balance(df, F.col("v") == 1, F.col("v") == 2, ["g"], ["id"]),
        "neighbours": lambda: order.neighbours(df, "v", ["g"], ["id"]),
        "heads": lambda: order.heads(df, F.col("v"), ["g"], ["id"], "h"),
        "ordinals": lambda: order.ordinals(df, ["g"], ["id"], "nth"),
    }
    want = {k: sorted(map(repr, f().collect())) for k, f in runs.items()}
    monkeypatch.setattr(scan, "ROWS", 40)
    for k, f in runs.items():
        assert sorted(map(repr, f().collect())) == want[k], k


def test_islands_tell_nulls_from_the_edge(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, None), ("a", 3, 5), ("a", 4, None)], "g string, o int, v int")
    assert [r.run for r in order.islands(df, "v", ["g"], ["o"], "run").orderBy("o").collect()] == [1, 1, 2, 3]


def test_largest_task_is_flat_when_a_group_grows(spark, monkeypatch):
    """Rows that one window of a large group gets: those of a range."""
    monkeypatch.setattr(scan, "ROWS", 500)
    most = []
    for n in (4000, 40_000):
        df = spark.range(n).select(F.lit("hot").alias("g"), F.col("id").alias("o"))
        seen = []
        keep = scan.checkpoints
        monkeypatch.setattr(scan, "checkpoints", lambda s, keep=keep: seen.append(1) or keep(s))
        out = scan.ordered(df.repartition(4), ["g"], ["o"], {"n": scan.Scan("number")})
        assert seen and out.agg(F.sum("n")).first()[0] == n * (n + 1) // 2
        monkeypatch.setattr(scan, "checkpoints", keep)
        # the same ranges again, as the operator makes them
        parts = df.repartitionByRange(-(-n // 500) * 2, "g", "o").groupBy(F.spark_partition_id()).count()
        most.append(parts.agg(F.max("count")).first()[0])
    assert most[1] < 3 * most[0] < 3 * 1000
