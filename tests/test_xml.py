"""XML documents of any depth, whole and in parts, against the standard library's tree."""

import random
from xml.etree import ElementTree

import pytest

from quire.sources import xml, xml_parts


def plain_nodes(text):
    """(pre, post, parent, depth, kind, name, attrs, text) by recursion over the tree; None if it is not well-formed."""
    try:
        root = ElementTree.fromstring(text)
    except ElementTree.ParseError:
        return None
    rows = []

    def visit(node, parent, depth):
        at = len(rows)
        rows.append([at, at, parent, depth, "element", node.tag.rpartition("}")[2], {k.rpartition("}")[2]: v for k, v in node.attrib.items()}, None])
        inside = [(None, node.text)] + [(c, c.tail) for c in node]
        for child, tail in inside:
            if child is not None:
                visit(child, at, depth + 1)
            if tail:
                rows.append([len(rows), len(rows), at, depth + 1, "text", None, None, tail])
        rows[at][1] = len(rows) - 1

    visit(root, None, 0)
    return rows


def told(rows):
    return {w: sorted([x.pre, x.post, x.parent, x.depth, x.kind, x["name"], x.attrs, x.text] for x in rows if x.work == w) for w in {x.work for x in rows}}


def made(r, depth=0):
    inner = "".join(r.choice((lambda: made(r, depth + 1), lambda: r.choice(("text", " ", "a &amp; b", "&#233;&lt;", "\r\n", "]]")), lambda: "<!-- <no> - -->", lambda: "<![CDATA[<x> & ]] ]]>", lambda: "<?do <it> ?>"))() for _ in range(r.randrange(5 if depth < 5 else 1)))
    name = r.choice(("a", "b-c", "n:d"))
    given = r.choice(("", " k='v>1'", ' k="&quot;x\'" m = "\t2"'))
    return f"<{name}{given}/>" if not inner and r.random() < 0.5 else f"<{name}{given} >{inner}</{name}>"


@pytest.fixture(scope="module")
def documents():
    r = random.Random(5)
    out = {}
    for i in range(30):
        text = f"<r xmlns:n='u' id='{i}'>{made(r)}{made(r)}</r>"
        out[f"d{i}"] = r.choice(("", "<?xml version='1.0'?>\n", " \n" if i % 2 else "", "<!DOCTYPE r [<!ELEMENT r ANY>]>\n", "<!DOCTYPE r>")) + text + r.choice(("", "\n", "<!-- end -->"))
    out |= {"bad1": "<a><b></a></b>", "bad2": "<a>", "bad3": "", "bad4": "<a/><b/>", "bad5": "x<a/>", "bad6": "<a>&nope;</a>", "bad7": "</a>", "bad8": "<a><!-- ", "bad9": "<a b=c/>", "bad10": "<a></a></a>"}
    return out


def test_shred_equals_the_tree(spark, documents):
    rows = xml.shred(spark.createDataFrame(list(documents.items()), "k string, x string"), "k", "x").collect()
    got = told(rows)
    for k, text in documents.items():
        want = plain_nodes(text)
        assert got[k] == sorted(want) if want else [x[4] for x in got[k]] == ["error"], k


def cuts(r, text, most):
    out, at = [], 0
    while at < len(text):
        n = r.randrange(1, most)
        out.append(text[at : at + n])
        at += n
    return out or [None]


@pytest.mark.parametrize("most", [3, 40])
def test_parts_equal_the_whole(spark, documents, most):
    r = random.Random(most)
    rows = [(k, n * 10, t) for k, text in documents.items() for n, t in enumerate(cuts(r, text, most))]
    r.shuffle(rows)
    got = told(xml_parts.shred_parts(spark.createDataFrame(rows, "w string, n int, t string"), "w", "n", "t").collect())
    for k, text in documents.items():
        want = plain_nodes(text)
        assert got[k] == sorted(want) if want else [x[4] for x in got[k]] == ["error"], (k, text)
    assert set(got) == set(documents)


def test_depth_of_100_000(spark):
    n = 100_000
    text = "<a>" * n + "x" + "</a>" * n
    whole = xml.shred(spark.createDataFrame([("d", text)], "k string, x string"), "k", "x")
    parts = xml_parts.shred_parts(spark.createDataFrame([("d", i, text[i : i + 70_001]) for i in range(0, len(text), 70_001)], "w string, n int, t string"), "w", "n", "t")
    for df in (whole, parts):
        x = df.selectExpr("count(*) AS n", "max(depth) AS d", "sum(if(kind = 'element', post - pre, 0)) AS s", "count_if(parent = pre - 1) AS c").first()
        assert (x.n, x.d, x.s, x.c) == (n + 1, n, n * (n + 1) // 2, n)
