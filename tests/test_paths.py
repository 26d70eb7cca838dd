"""Axes of node tables against a walk over the tree."""

import random

import pytest
from pyspark.sql import functions as F

from quire.operators import paths
from quire.sources import xml


@pytest.fixture(scope="module")
def forest(spark):
    r = random.Random(8)

    def made(depth):
        inner = "".join(r.choice((made(depth + 1) if depth < 5 else "", "said", " "))for _ in range(r.randrange(5)))
        name = r.choice("abc")
        return f'<{name} n="{r.randrange(3)}">{inner}</{name}>'

    docs = [(f"d{i}", f"<r>{made(0)}{made(0)}<header>{made(3)}</header></r>") for i in range(6)] + [("odd", "<r><a></r>")]
    nodes = xml.shred(spark.createDataFrame(docs, "k string, x string"), "k", "x").cache()
    rows = {(x.work, x.pre): x for x in nodes.collect() if x.kind != "error"}
    return nodes, rows


def plain(rows, start, axis):
    out = set()
    for key, x in rows.items():
        for s in start:
            y = rows[s]
            if x.work != y.work:
                continue
            inside, around = y.pre < x.pre <= y.post, x.pre < y.pre <= x.post
            same = x.parent is not None and x.parent == y.parent
            hit = {
                "self": key == s, "child": x.parent == y.pre, "parent": y.parent == x.pre, "descendant": inside, "descendant-or-self": inside or key == s,
                "ancestor": around, "ancestor-or-self": around or key == s, "following-sibling": same and x.pre > y.pre, "preceding-sibling": same and x.pre < y.pre,
            }
            if hit[axis]:
                out.add(key)
    return out


def keys(df):
    got = [(x.work, x.pre) for x in df.select("work", "pre").collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("axis", paths.AXES)
def test_axes(forest, axis):
    nodes, rows = forest
    start = {k for k, x in rows.items() if x.name == "b" or x.kind == "text" and x.pre % 3 == 0}
    chosen = nodes.filter("name = 'b' OR (kind = 'text' AND pre % 3 = 0)")
    got = paths.step(nodes, chosen.unionByName(chosen), axis)
    assert got.columns == nodes.columns and keys(got) == plain(rows, start, axis)
    named = paths.step(nodes, chosen, axis, "a", F.col("attrs")["n"] == "1")
    assert keys(named) == {k for k in plain(rows, start, axis) if rows[k].name == "a" and rows[k].attrs["n"] == "1"}


def test_sets_and_nearest(forest):
    nodes, rows = forest
    a, b = nodes.filter("name = 'a'"), nodes.filter("attrs['n'] = '2'")
    is_a, is_b = {k for k, x in rows.items() if x.name == "a"}, {k for k, x in rows.items() if (x.attrs or {}).get("n") == "2"}
    assert keys(paths.having(a, b)) == is_a & is_b and keys(paths.lacking(a, b)) == is_a - is_b and keys(paths.either(a, b, a)) == is_a | is_b
    got = {(x.work, x.pre): x.found for x in paths.nearest(nodes, b, "ancestor", "a").collect()}
    assert got == {k: max((p for w, p in plain(rows, {k}, "ancestor") if rows[w, p].name == "a"), default=None) for k in is_b}
    got = {(x.work, x.pre): x.found for x in paths.nearest(nodes, b, "child", "a").collect()}
    assert got == {k: min((p for w, p in plain(rows, {k}, "child") if rows[w, p].name == "a"), default=None) for k in is_b}
    got = {(x.work, x.pre): x.chain for x in paths.chains(nodes, b).collect()}
    assert got == {k: [rows[a].name for a in sorted(plain(rows, {k}, "ancestor"))] for k in is_b}
    with pytest.raises(ValueError, match="unknown axis"):
        paths.step(nodes, a, "preceding")


def test_texts_to_search(forest):
    nodes, rows = forest
    said = {k for k, x in rows.items() if x.kind == "text" and x.text.strip()}
    within = lambda test: plain(rows, {k for k, x in rows.items() if test(x)}, "descendant-or-self")
    said -= within(lambda x: x.name == "header")
    assert keys(paths.texts_to_search(nodes)) == said
    got = paths.texts_to_search(nodes, nodes.filter("name = 'a'"), nodes.filter("name = 'b'"))
    assert keys(got) == said & within(lambda x: x.name == "a") - within(lambda x: x.name == "b")


def test_module_findings(spark):
    df = lambda rows, kinds: spark.createDataFrame(rows, kinds)
    links = df([("D:a_32_b",), ("D:none W:x",), (" ",), (None,), ("D:none",)], "ref string")
    run = lambda words: sorted(map(tuple, paths.module_findings(df(words, "keyword string"), links, df([("p",), ("q",), (None,)], "src string"), df([("p",)], "path string"), "D").collect()))
    assert run([("a b",), ("c",), ("c",)]) == [("duplicate keyword", "c", 2), ("empty target", "", 2), ("missing file", "q", 1), ("missing target", "D:none", 2)]
    assert run([]) == [("empty target", "", 2), ("missing file", "q", 1)]
