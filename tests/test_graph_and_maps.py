"""Job levels, bounded collections, ranges, structural joins and verse maps against plain versions."""

import random
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quire.operators import integrity, ranges, scan, verses
from quire.plans import graph


def test_levels_of_layers_and_cycles(spark):
    layers = [(f"j{n}.{i}", f"j{n - 1}.{k}") for n in range(1, 13) for i in range(3) for k in range(3)]
    began = time.time()
    got = {r.name: (r.level, r.state) for r in graph.levels(spark.createDataFrame(layers, "job string, needs string")).collect()}
    assert got == {f"j{n}.{i}": (n, "ready") for n in range(13) for i in range(3)}
    assert time.time() - began < 300  # all paths would be 3**12 a job
    deps = [("a", "b"), ("b", "a"), ("c", "a"), ("d", "c"), ("x", "y"), ("c", "x"), ("s", "s"), ("m", "a"), ("s", "m"), ("x", "y"), (None, "y"), ("y", None)]
    got = {r.name: (r.level, r.state) for r in graph.levels(spark.createDataFrame(deps, "job string, needs string")).collect()}
    cycle, blocked = (None, "cycle"), (None, "blocked")
    assert got == {"a": cycle, "b": cycle, "s": cycle, "m": cycle, "c": blocked, "d": blocked, "x": (1, "ready"), "y": (0, "ready")}
    assert graph.levels(spark.createDataFrame([], "job string, needs string")).count() == 0


def plain_collections(sizes, most, overhead, each):
    used, k, out = 0, 1, []
    for i, n in enumerate(sizes):
        if i and overhead + used + n + each > most:
            used, k = 0, k + 1
        used += n + each
        out.append(k)
    return out


@pytest.mark.parametrize("limit", [2**20, 20])
def test_collections_equal_the_loop(spark, monkeypatch, limit):
    monkeypatch.setattr(scan, "ROWS", limit)
    r = random.Random(1)
    groups = {g: [r.choice((0, 1, r.randrange(60), 400)) for _ in range(n)] for g, n in (("big", 300), ("one", 1), ("few", 5), (None, 12))}
    df = spark.createDataFrame([(g, i, n, "x") for g, sizes in groups.items() for i, n in enumerate(sizes)], "g string, o int, size int, `sum_` string")
    for most, overhead, each in ((100, 0, 0), (100, 10, 1), (5, 9, 0)):
        got = defaultdict(list)
        out = graph.bounded_collections(df, "g", "o", "size", most, overhead, each)
        assert out.columns == [*df.columns, "collection"]
        for x in sorted(out.collect(), key=lambda x: x.o):
            got[x.g].append(x.collection)
        assert got == {g: plain_collections(s, most, overhead, each) for g, s in groups.items()}
    assert graph.bounded_collections(df.limit(0), "g", "o", "size", 10).count() == 0


def test_points_in_ranges(spark):
    r = random.Random(2)
    points = [(r.choice("ab"), r.choice((None, r.randrange(-300, 3000)))) for _ in range(300)]
    spans = [(i, r.choice("ab"), a, a + r.choice((-1, 0, 1, 7, 8, 63, 64, r.randrange(2000)))) for i in range(80) for a in (r.randrange(-300, 3000),)] + [(90, "a", None, 5)]
    p, s = spark.createDataFrame(points, "g string, n int"), spark.createDataFrame(spans, "id int, g string, lo int, hi int")
    got = sorted((x.g, x.n, x.id) for x in ranges.in_range(p, s, "n", "lo", "hi", ["g"]).collect())
    assert got == sorted((g, n, i) for g, n in points if n is not None for i, k, lo, hi in spans if lo is not None and k == g and lo <= n <= hi)
    assert ranges.in_range(p, s.limit(0), "n", "lo", "hi", ["g"]).count() == 0


def test_rows_of_a_range_do_not_follow_its_length(spark):
    spans = spark.createDataFrame([(10**k + 3, 2 * 10**k + 11) for k in range(1, 16)], "lo long, hi long")
    rows = [x.n for x in spans.select("lo", F.size(ranges._cover(F.col("lo"), F.col("hi"), 18)).alias("n")).orderBy("lo").collect()]
    assert max(rows) <= 14 * 17 and rows[14] < 20 * rows[2]
    covered = spans.filter("lo < 100000").select("lo", "hi", F.explode(ranges._cover(F.col("lo"), F.col("hi"), 18)).alias("b")).withColumn("n", F.shiftleft(F.lit(1).cast("long"), 3).cast("long"))
    total = covered.groupBy("lo", "hi").agg(F.sum(F.pow(F.lit(8.0), F.col("b.level"))).alias("n")).collect()
    assert all(x.n == x.hi - x.lo + 1 for x in total)


@pytest.mark.parametrize("shape", ["deep", "flat", "mixed"])
def test_ancestors(spark, shape):
    n, r = 400, random.Random(3)
    parent = [None] + [i - 1 if shape == "deep" else 0 if shape == "flat" else r.randrange(max(0, i - 5), i) for i in range(1, n)]
    if shape == "mixed":  # document order: a parent is on the open path
        path = [0]
        for i in range(1, n):
            del path[r.randrange(1, len(path) + 1) :]
            parent[i] = path[-1]
            path.append(i)
    post = list(range(n))
    for i in range(n - 1, 0, -1):
        post[parent[i]] = max(post[parent[i]], post[i])
    nodes = spark.createDataFrame([("w", "b", i, post[i]) for i in range(n)], "work string, book string, pre int, post int")
    got = {(x.a_pre, x.d_pre) for x in integrity.ancestors(nodes, F.col("pre") % 3 == 0, F.col("pre") % 2 == 1).collect()}
    want = set()
    for i in range(1, n, 2):
        at = parent[i]
        while at is not None:
            if at % 3 == 0:
                want.add((at, i))
            at = parent[at]
    assert got == want


def plain_map(canon, lines):
    """The source verses of one book that has them all, matched one by one with the fixed ones that are there."""
    missing, splits, extra, told = set(), set(), set(), {}
    for op, ch, *rest in lines:
        if op == "MISSING":
            missing |= {(ch, v) for v in range(rest[0], rest[1] + 1)}
        elif op == "SPLIT":
            splits.add((ch, rest[0]))
        elif op == "EXTRA":
            extra |= {(ch, v) for v in range(rest[0], rest[1] + 1)}
        else:
            a, b, to_ch, to = rest
            for k in range(b - a + 1):
                told[(ch, a + k)] = (to_ch, to + k)
            missing |= {(ch, v) for v in range(a, b + 1)}
            extra |= {(to_ch, to + k) for k in range(b - a + 1)}
    fixed = [(c, v) for c, n in enumerate(canon, 1) for v in range(1, n + 1)]
    out, number, now = {}, 0, None
    for c, v in fixed:
        here = c + sum(s <= (c, v) for s in splits)
        if here != now:
            now, number = here, 0
        if (c, v) in missing:
            continue
        number += 1
        while (here, number) in extra:
            number += 1
        out[(c, v)] = (here, number)
    rows = set()
    name = lambda x: x and f"A.{x[0]}.{x[1]}"
    for c, v in fixed:
        if (c, v) in out or (c, v) in told:
            src = told.get((c, v)) or out[(c, v)]
            rows.add((name((c, v)), name(src), "same" if src == (c, v) else "moved"))
        else:
            before = [out[x] for x in fixed if x[0] == c and x < (c, v) and x in out][-1:]
            behind = [out[x] for x in fixed if x[0] == c and x > (c, v) and x in out][:1]
            rows.add((name((c, v)), name((before or behind or [None])[0]), "missing"))
    line = sorted((src, f) for f, src in out.items())
    for x in extra - set(told.values()):
        host = [f for src, f in line if src < x][-1:] or [f for src, f in line if src > x][:1]
        rows.add((name(host[0]) if host else None, name(x), "extra"))
    return rows


def test_verse_maps_by_brute_force(spark):
    r = random.Random(4)
    index, raw, want = [], [], set()
    for n in range(40):
        book = f"B{n}"
        canon = [r.randrange(3, 9) for _ in range(r.randrange(1, 6))]
        lines = []
        for ch, last in enumerate(canon, 1):
            for _ in range(r.randrange(3)):
                v = r.randrange(1, last + 1)
                what = r.choice(("MISSING", "SPLIT", "SPLIT", "EXTRA"))
                lines.append((what, ch, max(2, v)) if what == "SPLIT" else (what, ch, v, min(last, v + r.randrange(2))))
        if r.random() < 0.3:
            lines = [x for x in lines if x[0] == "SPLIT" and x[1] > 1] + [("MOVED", 1, 2, 2, 1, 1)]
        shapes = {"SPLIT": "VSYS_CHAPTER_SPLIT_AT: {b}.{0}.{1}", "MISSING": "VSYS_MISSING: {b}.{0}.{1}.{2}", "EXTRA": "VSYS_EXTRA: {b}.{0}.{1}.{2}", "MOVED": "VSYS_MOVED: {b}.{0}.{1}.{2} -> {b}.{3}.{4}"}
        raw += [shapes[x[0]].format(*x[1:], b=book) for x in lines]
        index += [(book, c, v) for c, m in enumerate(canon, 1) for v in range(1, m + 1)]
        want |= {tuple(x and x.replace("A.", f"{book}.", 1) for x in row) for row in plain_map(canon, lines)}
    inst = verses.instructions(spark.createDataFrame(list(enumerate(raw)), "line_no int, raw string"))
    rows = verses.verse_maps(spark.createDataFrame(index, "book string, ch int, vs int"), inst, extra=True).collect()
    got = {(x.fixed_id, x.src_id, x.status) for x in rows}
    assert got == want and len(rows) == len(want)
    one = [x.src_id for x in rows if x.status in ("same", "moved")]
    assert len(one) == len(set(one))


def test_splits_compose_and_whole_chapters(spark):
    idx = lambda canon: spark.createDataFrame([("A", c, v) for c, n in enumerate(canon, 1) for v in range(1, n + 1)], "book string, ch int, vs int")
    run = lambda canon, lines, source=None: {(x.fixed_id, x.src_id, x.alt_label, x.status) for x in verses.verse_maps(idx(canon), verses.instructions(spark.createDataFrame(list(enumerate(lines)), "line_no int, raw string")), source and idx(source), extra=True).collect()}
    got = run([1, 4, 1, 1], ["VSYS_CHAPTER_SPLIT_AT: A.2.3", "VSYS_CHAPTER_SPLIT_AT: A.2.4"])
    assert {x[:3] for x in got} == {("A.1.1", "A.1.1", None), ("A.2.1", "A.2.1", None), ("A.2.2", "A.2.2", None), ("A.2.3", "A.3.1", "(3:1)"), ("A.2.4", "A.4.1", "(4:1)"), ("A.3.1", "A.5.1", "(5:1)"), ("A.4.1", "A.6.1", "(6:1)")}
    whole = run([2], ["VSYS_EXTRA: A.2"], [2, 2])
    assert {x for x in whole if x[3] == "extra"} == {("A.1.2", "A.2.1", None, "extra"), ("A.1.2", "A.2.2", None, "extra")} and len(whole) == 4
    assert run([2, 1], ["VSYS_MISSING: A.2"]) == {("A.1.1", "A.1.1", None, "same"), ("A.1.2", "A.1.2", None, "same"), ("A.2.1", None, None, "missing")}
    first = run([3], ["VSYS_MISSING: A.1.1"])
    assert first == {("A.1.1", "A.1.1", None, "missing"), ("A.1.2", "A.1.1", "(1)", "moved"), ("A.1.3", "A.1.2", "(2)", "moved")}
    absorbed = run([3], ["VSYS_MISSING: A.1.2", "VSYS_MISSING: A.1.2.3", "VSYS_MISSING: A.1.3.PART"])  # overlapping ones count once
    assert {x[1] for x in absorbed} == {"A.1.1"}


def test_verse_maps_broadcast_nothing(spark):
    index = spark.createDataFrame([("A", c, v) for c in (1, 2) for v in range(1, 9)], "book string, ch int, vs int")
    inst = verses.instructions(spark.createDataFrame([(1, "VSYS_MISSING: A.1.3.4"), (2, "VSYS_FROM_TO: A.2.1 -> A.1.7")], "line_no int, raw string"))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    points, spans = index.select("vs"), index.select((F.col("vs") - 1).alias("a"), F.col("vs").alias("b"))
    assert "Broadcast" not in plan(verses.verse_maps(index, inst)) and "Broadcast" not in plan(ranges.in_range(points, spans, "vs", "a", "b", longest=2))


def test_lines_of_instructions_are_matched_once(spark):
    lines = spark.createDataFrame([(1, "VSYS_MISSING: A.1.3.4"), (2, "VSYS_EXTRA: A.1.5.PART"), (3, "VSYS_MISSING: A\x1f1"), (4, "VSYS_x"), (5, "VSYS_EMPTY: A.2\u2028"), (6, None)], "line_no int, raw string")
    inst = verses.instructions(lines)
    said = inst.filter("valid")._jdf.queryExecution().optimizedPlan().toString()
    assert said.count("regexp_") == 1 and said.count("RegExp") == 0
    assert [tuple(r)[:7] for r in inst.orderBy("line_no").collect()] == [
        (1, "MISSING", "A", 1, 3, 4, False), (2, "EXTRA", "A", 1, 5, 5, True), (3, None, None, None, None, None, False), (4, None, None, None, None, None, False), (5, "EMPTY", "A", 2, None, None, False),
    ]


def test_points_stand_in_the_last_piece_before_them(spark):
    points = spark.createDataFrame([("a", n, f"p{n}") for n in range(5)] + [("b", 1, "q"), (None, 1, "r")], "g string, n int, more string")
    pieces = spark.createDataFrame([("a", 1, 10), ("a", 3, 30), ("b", None, 0), ("c", 1, 5)], "g string, low int, x int").select("g", "low", F.struct("x").alias("said"))
    got = verses._standing(points, pieces, ["g"], "n")
    assert {(r.g, r.n, r.more, r.said and r.said.x) for r in got.collect()} == {("a", 0, "p0", None), ("a", 1, "p1", 10), ("a", 2, "p2", 10), ("a", 3, "p3", 30), ("a", 4, "p4", 30), ("b", 1, "q", 0), (None, 1, "r", None)}
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()


def test_lookup_deals_a_hot_key_over_tasks(spark, monkeypatch):
    for name, n in (("REFS", 16), ("TARGETS", 4)):
        monkeypatch.setattr(integrity, name, n, raising=False)
    refs = [(i % 90, "hot x") for i in range(100)] + [(200, "cold  hot"), (201, "warm"), (202, None), (203, "")]
    targets = [(i % 45, "other hot") for i in range(50)] + [(60, "cold"), (61, "warm"), (61, "warm"), (62, None)]
    got = integrity.lookup(spark.createDataFrame(refs, "r int, ref string"), spark.createDataFrame(targets, "t int, ident string"), "ref", "ident")
    assert got.columns == ["r", "ref", "t", "ident"]
    rows = got.withColumn("task", F.spark_partition_id()).collect()
    want = sorted((r, t) for r, a in refs for t, b in targets for x in (a or "").split() for y in (b or "").split() if x == y)
    assert sorted((x.r, x.t) for x in rows) == want and len(want) == 101 * 50 + 3
    tasks = defaultdict(int)
    for x in rows:
        tasks[x.task] += 1
    assert max(tasks.values()) < len(want) / 4  # a hot key was one task's


def test_runs_within_chapters_in_small_tasks(spark, monkeypatch):
    monkeypatch.setattr(ranges, "BLOCK", 16)
    monkeypatch.setattr(ranges, "TASK", 32)
    r = random.Random(5)
    rows = [(g, n) for g in "ab" for n in r.sample(range(-100, 400), 350)] * 2
    df = spark.createDataFrame(rows, "g string, n long").withColumn("ch", F.floor(F.col("n") / 10))
    got = ranges.compress(df, ["g"], "n", ["ch"])
    want, there = set(), set(rows)
    for g, n in there:
        if n % 10 == 0 or (g, n - 1) not in there:
            end = n
            while end % 10 < 9 and (g, end + 1) in there:
                end += 1
            want.add((g, n // 10, n, end, end - n + 1))
    found = got.withColumn("task", F.spark_partition_id()).collect()
    assert sorted((x.g, x.ch, x.lo, x.hi, x.n) for x in found) == sorted(want)
    assert len({x.task for x in found}) > len(rows) / 32 / 2  # small exchanges came as one task
