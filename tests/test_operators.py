"""Operators on small cases of their own."""

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import integrity, order, publish, ranges, references, terms, verses
from quire.plans import graph
from quire.plans.queries import QUERIES, SQL
from quire.sources import commands, conf, html, xml

CANON = [("S", "A", 1, "OT", 1, 3), ("S", "A", 1, "OT", 2, 2), ("S", "B", 2, "NT", 1, 4)]


def canon(spark):
    return spark.createDataFrame(CANON, "vsys string, book string, book_ord int, testament string, ch int, last_vs int")


def expanded(spark, ref):
    got = ranges.expand_refs(spark.createDataFrame([(1, ref)], "k int, r string"), ranges.verse_index(canon(spark)), "k", "r", "S")
    return [f"{r.book}.{r.ch}.{r.vs}" for r in got.orderBy("ord").collect()]


def scoped(spark, ids):
    rows = [(1, b, int(c), int(v)) for b, c, v in (i.split(".") for i in ids)]
    got = ranges.scope_string(spark.createDataFrame(rows, "k int, book string, ch int, vs int"), ranges.verse_index(canon(spark)), ["k"], "S")
    return got.first().scope


def test_expand(spark):
    assert expanded(spark, "A.1-A.2") == ["A.1.1", "A.1.2", "A.1.3", "A.2.1", "A.2.2"]
    assert expanded(spark, "W:A.1.3-B.1.1") == ["A.1.3", "A.2.1", "A.2.2", "B.1.1"]
    assert expanded(spark, "NT") == ["B.1.1", "B.1.2", "B.1.3", "B.1.4"]
    assert expanded(spark, "Q.1") == []


def test_scope(spark):
    assert scoped(spark, ["A.1.2", "A.1.3", "A.2.1"]) == "A.1.2-A.2.1"
    assert scoped(spark, ["A.1.1", "A.1.2", "A.1.3", "A.2.1", "A.2.2"]) == "A"
    assert scoped(spark, ["A.1.1", "A.1.2", "A.1.3", "B.1.2"]) == "A.1 B.1.2"
    assert scoped(spark, ["B.1.2", "Z.1.1"]) == "B.1.2 Z"
    for ref in ("A", "A.1", "A.1.2-B.1.1"):
        assert scoped(spark, expanded(spark, ref)) == ref


def test_encode_roundtrip(spark):
    cases = ["a b", "_65_", "_95_65_95_", "Ёж—漢🙂", "", "x_y"]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    rows = df.select("s", T.encode_ref(F.col("s")).alias("e"), T.decode_ref(T.encode_ref(F.col("s"))).alias("d")).collect()
    assert [r.d for r in rows] == cases
    assert rows[0].e == "a_32_b"


def test_external_refs(spark):
    books = spark.createDataFrame([("GEN", "Gen"), ("EXO", "Exod")], "abbr string, book string")
    df = spark.createDataFrame([(1, "GEN 1:2-4, EXO 5; GEN 1-3, what 7")], "k int, t string")
    assert [r.ref for r in ranges.external_refs(df, "k", "t", books).orderBy("item").collect()] == ["Gen.1.2-Gen.1.4", "Exod.5", "Gen.1-Gen.3", "what 7"]


GRAMMAR = references.Grammar(references.Settings({"Genesis": "Gen", "A": "A", "Jude": "Jude", "Psalms": "Ps"}))


def refs(text, book="A", ch=7):
    return [(r["type"], r["ref"]) for r in references.find(GRAMMAR, text, book, ch)]


def test_reference_forms():
    assert refs("A 1:2-3; 2:1, 2") == [("T02", "A.1.2-A.1.3"), ("T03", "A.2.1"), ("T10", "A.2.2")]
    assert refs("Genesis 1:31-2:3") == [("T01", "Gen.1.31")]
    assert refs("3 chapter 4-5 verses") == [("T04", "A.3.4-A.3.5")]
    assert refs("1-2 chapter") == [("T05", "A.1")]
    assert refs("4 chapter") == [("T06", "A.4")]
    assert refs("3-4 verses") == [("T07", "A.7.3-A.7.4")]
    assert refs("3 verse") == [("T08", "A.7.3")]
    assert refs("Jude 4, 5") == [("T09", "Jude.1.4"), ("T10", "Jude.1.5")]
    assert refs("Genesis 5, 6:1.") == [("T09", "Gen.5"), ("T03", "Gen.6.1")]
    assert refs("chapter 3 verse 4") == [("T11", "A.3.4")]
    assert refs("chapter 3") == [("T12", "A.3")]
    assert refs("verse 9") == [("T13", "A.7.9")]
    assert refs("Psalms 3:0") == [("T03", "Ps.3.1")]
    assert refs("no reference, 12 men") == []


@settings(max_examples=60, deadline=None)
@given(st.text("Genesi A1:2-3;,.and chapter", max_size=60))
def test_links_are_their_text(text):
    for r in references.find(GRAMMAR, text, "A", 1):
        assert text[r["start"] : r["end"]] == r["text"]


def test_term_rules():
    house = terms.Rule("House", "D:House", r"/\b(\Qhouse\E\S*)/i")
    loud = terms.Rule("Loud", "D:Loud", r"/\b(loud)\b/", multiple="true")
    quiet = terms.Rule("In", "D:In", r"/\b(in)\b/", dont_link=True)
    compiled = [(r, terms.compile_rule(r.pattern)) for r in (house, loud, quiet)]
    got = terms.link_context([(1, "loud House in a house, loud", "A.1.1", "OT", False), (2, "houses loud", "A.1.2", "OT", False)], compiled)
    assert got == [(1, 0, 4, 1), (1, 5, 10, 0), (1, 23, 27, 1), (2, 7, 11, 1)]


def test_default_rules(spark):
    got = terms.default_rules(spark.createDataFrame([("Ark, the.dup1",), ("Noah",)], "k string"), "k").collect()
    assert {(r.entry, r.variant) for r in got} == {("Ark, the.dup1", "Ark, the"), ("Ark, the.dup1", "Ark"), ("Ark, the.dup1", "the"), ("Noah", "Noah")}
    assert next(r.pattern for r in got if r.variant == "Noah") == r"/\b(\QNoah\E\S*)/i"


def test_verse_map(spark):
    idx = ranges.verse_index(canon(spark))
    lines = spark.createDataFrame([(1, "VSYS_MISSING: A.1.2"), (2, "VSYS_EXTRA: B.1.2.3"), (3, "nothing")], "line_no int, raw string")
    got = {r.fixed_id: (r.src_id, r.alt_label) for r in verses.verse_maps(idx, verses.instructions(lines)).collect()}
    assert got["A.1.1"] == ("A.1.1", None) and got["A.1.2"] == ("A.1.1", None) and got["A.1.3"] == ("A.1.2", "(2)")
    assert got["B.1.1"] == ("B.1.1", None) and got["B.1.2"] == ("B.1.4", "(4)")
    moved = verses.moved_map(verses.instructions(spark.createDataFrame([(1, "VSYS_FROM_TO: A.1.1.2 -> B.1.3.4")], "line_no int, raw string"))).collect()
    assert sorted((r.map_from, r.map_to) for r in moved) == [("A.1.1", "B.1.3"), ("A.1.2", "B.1.4")]


def test_sequence_findings(spark):
    df = spark.createDataFrame([(1, 1), (1, 3)], "ch int, vs int")
    assert [tuple(r) for r in order.sequence_findings(df, "vs", ["ch"], ["vs"]).collect()] == [(1, 2, 3, "missing")]


def test_inheritance_and_overlay(spark):
    df = spark.createDataFrame([("n", 1, None, "x"), ("n", 2, "y", None)], "node string, depth int, context string, notContext string")
    r = integrity.inherit(df, "node", "depth", "context", "notContext").first()
    assert (r.context, r.notContext) == ("y", "")
    layers = spark.createDataFrame([("e", 3, "3"), ("e", 2, "2"), ("e", 1, "1"), ("f", 3, "false")], "entry string, p int, value string")
    assert {r.entry: r.value for r in integrity.overlay(layers, ["entry"], "p", "value").collect()} == {"e": "1", "f": ""}


def test_duplicates(spark):
    df = spark.createDataFrame([("Ark", 1), ("ark", 2), ("Dove", 3)], "k string, pre int")
    assert [r.entry_id for r in integrity.duplicates_by_key(df, F.col("k"), ["pre"]).orderBy("pre").collect()] == ["Ark.dup1", "Ark.dup2", "Dove"]


def test_reconcile_repairs_case(spark):
    a, b = spark.createDataFrame([("X",), ("y",), ("z",)], "k string"), spark.createDataFrame([("x",), ("y",)], "k string")
    assert {r.left_key: r.status for r in integrity.reconcile(a, b, "k").collect()} == {"X": "case repaired", "y": "both", "z": "left only"}


def test_commands(spark):
    text = "# note\nEVAL_REGEX(a): s/1/x/\nRUN: one\nRUN: two\nEVAL_REGEX(a):\nRUN: three\nMODE: m\nSET(x): 1\nodd line\n"
    lines = commands.lines_of(spark.createDataFrame([("f", text)], "path string, t string"), "path", "t")
    assert lines.count() == 9
    cmds = commands.commands(lines, "path")
    assert [(r.run_value, r.rule_value) for r in commands.rules_in_force(cmds, "path").orderBy("run_line").collect()] == [("one", "s/1/x/"), ("two", "s/1/x/")]
    assert commands.with_mode(cmds, "path").filter("command = 'SET'").first().mode == "m"
    assert cmds.filter("command = '?'").first().value == "odd line"


def test_markers(spark):
    text = "\\id GEN first\n\\toc1 Genesis\n\\c 1\n\\v 1 In \\w begin|lemma=\"b\"\\w* ning\n\\toc1 later"
    marks = commands.markers(commands.lines_of(spark.createDataFrame([("f", text)], "path string, t string"), "path", "t"), "path")
    facts = commands.file_facts(marks, "path").first()
    assert facts["id"] == "GEN first" and facts["toc1"] == "Genesis"
    assert marks.filter("marker = 'w' AND NOT is_end").first().attrs == 'lemma="b"'
    kinds = commands.classify(commands.file_facts(marks, "path"), spark.createDataFrame([("GEN",)], "code string"))
    assert kinds.first().kind == "bible"


def test_conf():
    files = {"a/main.conf": "x=1\n[S]\nm=a\nm=b\nInclude:more.conf\nx=undef\nlong=one \\\ntwo", "a/more.conf": "y=2"}
    rows = conf.parse("a/main.conf", files.__getitem__, ["m"])
    assert ("MAIN", "x", 0, "1", "a/main.conf") in rows and ("S", "m", 1, "b", "a/main.conf") in rows
    assert ("MAIN", "y", 0, "2", "a/more.conf") in rows and ("S", "x", 0, None, "a/main.conf") in rows
    assert any(r[1] == "long" and r[3].startswith("one") and r[3].endswith("two") for r in rows)


def test_preamble_and_log(spark):
    lines = commands.lines_of(spark.createDataFrame([("f", "a,1\nterm,gloss\nx,y")], "path string, t string"), "path", "t")
    head, data = commands.with_preamble(lines, "path", F.col("raw").startswith("term,"))
    assert [r.raw for r in head.collect()] == ["a,1"] and [r.raw for r in data.collect()] == ["x,y"]
    log = commands.lines_of(spark.createDataFrame([("f", "run ERROR: bad\nfine")], "path string, t string"), "path", "t")
    assert [(r.severity, r.message) for r in commands.findings_from_log(log, "path").collect()] == [("ERROR", "bad")]


def test_xml_roundtrip(spark):
    doc = '<d n="1">a<b>c</b> tail<e/></d>'
    df = spark.createDataFrame([("w", doc), ("bad", "<x>")], "k string, x string")
    nodes = xml.shred(df, "k", "x")
    assert xml.serialise(nodes.filter("work = 'w'")).first().xml == doc
    assert nodes.filter("kind = 'error'").first().work == "bad"


def test_html(spark):
    page = "<html><head><title>t</title></head><body><p>One <b>two</b><script>no</script><!-- c --></p><a href='#n1'>1</a><div id='n1'>note</div></body></html>"
    ev = html.html_events(spark.createDataFrame([(1, page)], "k int, h string"), "k", "h")
    assert [(r.name, r.value) for r in ev.filter("kind = 'text'").orderBy("seq").collect()] == [("p", "One"), ("b+p", "two"), ("a", "1"), ("div", "note")]
    assert html.note_pairs(ev, "k").first().note == "n1"


def test_collections(spark):
    df = spark.createDataFrame([("t", i, 40) for i in range(5)], "g string, o int, size long")
    assert [r.collection for r in graph.bounded_collections(df, "g", "o", "size", 100).orderBy("o").collect()] == [1, 1, 2, 2, 3]


def test_placement_and_toc(spark):
    nodes = spark.createDataFrame([("w", i) for i in range(6)], "work string, pre int")
    moves = spark.createDataFrame([("w", "move", 1, 2, 5), ("w", "copy", 0, 0, 4), ("w", "remove", 3, 3, 0)], "work string, action string, pre_lo int, pre_hi int, before int")
    assert [r.pre for r in publish.place(nodes, moves).orderBy("new_pre").collect()] == [0, 0, 4, 1, 2, 5]
    toc = spark.createDataFrame([("w", 0, 9, True, "a"), ("w", 1, 4, True, "b"), ("w", 5, 5, True, "[level1]c")], "work string, pre int, post int, is_toc boolean, text string")
    assert [r.level for r in publish.toc_levels(toc).orderBy("pre").collect()] == [1, 2, 1]


def test_paths_and_collation(spark):
    df = spark.createDataFrame([("a/b/c.html", "a/d/e.html#x"), ("a/c.html", "a/c.html#y")], "s string, t string")
    assert [r[0] for r in df.select(T.relative_path(F.col("s"), F.col("t"))).collect()] == ["../d/e.html#x", "#y"]
    words = spark.createDataFrame([("cb",), ("chb",), ("ca",), ("b",)], "w string")
    assert [r.w for r in words.orderBy(T.sort_key(F.col("w"), ["b", "c", "ch", "a"])).collect()] == ["b", "cb", "ca", "chb"]


def test_runs_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(ranges, "BLOCK", 4)
    monkeypatch.setattr(ranges, "TASK", 16)
    held = {"a": [*range(-9, 30), 40, 41, 43, 44, 45, 47, 48], "b": [3, 4, 8, 9, 10, 11, 12, 15, 16], "c": [7], None: [3, 4, 5]}
    rows = [(k, n) for k, ns in held.items() for n in ns + ns[::2]] + [("c", None), ("c", None)]
    want = []
    for k, ns in held.items():
        starts = [n for n in ns if n - 1 not in ns]
        want += [(k, s, next(n for n in range(s, 99) if n + 1 not in ns)) for s in starts]
    df = ranges.compress(spark.createDataFrame(rows, "k string, n long"), ["k"], "n")
    assert df.columns == ["k", "lo", "hi", "n"]
    assert sorted(map(str, df.collect())) == sorted([f"Row(k={k!r}, lo={a}, hi={b}, n={b - a + 1})" for k, a, b in want] + ["Row(k='c', lo=None, hi=None, n=1)"])


def test_html_of_one_partition_is_dealt_out(spark):
    pages = spark.range(0, 500, 1, 1).select("id", F.lit("<body><p>a</p></body>").alias("html"))
    events = html.html_events(pages, "id", "html")
    assert events.count() == 2500 and events.select("id", F.spark_partition_id().alias("p")).select("p").distinct().count() > 8


def test_html_entities_as_written(spark, tmp_path):
    odd = ["cut &quot", "cut &amp", "&quot;a&quot; &amp;lt; &lt;&nbsp;&#39;&copy &copy;", "a\u00a0 b\x0bc\u3000", "&", "\u00a0", 'x<a href="?a=1&amp;b=2&copy">y</a>z &am']
    rows = [(i, f"<html><body><p>{x}</p></body></html>") for i, x in enumerate(odd)] + [(90, "<html><body><p>cut here &quot"), (91, None), (92, "&quot")]
    spark.createDataFrame(rows, "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    want = db.execute(SQL["html_events"]).fetchall()
    assert (90, 2, "text", "p", "cut here &quot") in want
    assert sorted(map(tuple, QUERIES["html_events"](spark, str(tmp_path)).collect())) == sorted(want)
    # without names all that HTML knows are decoded, as before
    said = html.html_events(spark.createDataFrame(rows[:1], "k long, h string"), "k", "h").filter("kind = 'text'").collect()
    assert [r.value for r in said] == ['cut "']


def test_lookup_dealt_evenly(spark):
    refs, targets = spark.range(20_000).select("id", F.lit("a b").alias("ref")), spark.range(2_000).select(F.col("id").alias("t"), F.lit("b c").alias("ident"))
    got = integrity.lookup(refs, targets, "ref", "ident").groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"), F.sum("id").alias("i"), F.sum("t").alias("t")).collect()
    assert sum(r.n for r in got) == 40_000_000 and max(r.n for r in got) < 1 << 23
    assert sum(r.i for r in got) == 2_000 * sum(range(20_000)) and sum(r.t for r in got) == 20_000 * sum(range(2_000))


def test_links_packed_in_slices(spark):
    texts = [None if i % 9 == 4 else "nothing" if i % 9 == 5 else f"see Genesis {i % 40 + 1}:2-3; 4" for i in range(3 * references.SLICE + 5)]
    s = references.Settings({"Genesis": "Gen"})
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").coalesce(1)
    got = {r.i: [x.ref for x in r.links] for r in references.link_references(df, "t", s).collect()}
    assert got == {i: [x["ref"] for x in references.find(references.Grammar(s), t)] if t else [] for i, t in enumerate(texts)}
