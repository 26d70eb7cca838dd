"""Checks, links and streams on small cases."""

import time

from pyspark.sql import functions as F

from quire.operators import integrity, publish, quality
from quire.sources import conf, xml
from quire.streaming.sessions import new_findings, session_counts


def test_explicit_links(spark):
    marks = spark.createDataFrame([("p1", "Ark", "the boat of Noah: "), ("p2", "Dove", "x")], "location string, lemma string, before string")
    entries = spark.createDataFrame([("ark1", "ark", "temple"), ("ark2", "Ark", "noah")], "entry string, name string, context string")
    assert {r.location: r.entry for r in quality.explicit_links(marks, entries).collect()} == {"p1": "ark2", "p2": None}


def test_insertion_and_schema(spark):
    nodes = xml.shred(spark.createDataFrame([("w", "<d><p><v/>text</p><q/></d>")], "k string, x string"), "k", "x")
    rules = spark.createDataFrame([("d", "p"), ("p", "v")], "parent string, child string")
    assert [r.message for r in quality.schema_findings(nodes, rules).collect()] == ["q in d"]
    verses = spark.createDataFrame([("b", "v1", 2, 3), ("b", "v2", 9, 12)], "book string, id string, pre int, until int")
    got = quality.insertion_points(nodes.withColumn("book", F.lit("b")), verses).collect()
    assert {r.id: r.insert_at for r in got} == {"v1": 3, "v2": None}


def test_rule_and_context_findings(spark):
    rules = spark.createDataFrame([("r", "osisRef", "Ark"), ("r", "colour", "x")], "rule string, attribute string, value string")
    assert {r.check for r in quality.rule_findings(rules, ["osisRef"]).collect()} == {"attribute", "work prefix"}
    values = spark.createDataFrame([("r", "ALL"), ("r", "Gen"), ("r", "Gone")], "rule string, value string")
    assert [r.message for r in quality.context_findings(values, spark.createDataFrame([("Gen",)], "id string")).collect()] == ["Gone"]


def test_imports_views_and_siblings(spark):
    cells = spark.createDataFrame([("cell", "12.5", None), ("cell", " ", None), ("k", "(Ark),", None)], "name string, text string, type string")
    assert [(r.text, r.type) for r in quality.imported(cells).collect()] == [("12.5", "x-right"), (" ", None), ("Ark", None)]
    nodes = spark.createDataFrame([("a", "s", "f", None), ("b", None, None, "source")], "id string, src_id string, fitted_id string, only_in string")
    assert [r.id for r in quality.view(nodes, "fitted").collect()] == ["f"] and quality.view(nodes, "source").count() == 2
    tree = spark.createDataFrame([("w", 0, None, "d"), ("w", 1, 0, "p"), ("w", 2, 1, "a"), ("w", 3, 1, "x"), ("w", 4, 1, "b")], "work string, pre int, parent int, name string")
    assert {r.pre: r.parent for r in quality.cut_siblings(tree, F.col("name") == "x").collect()} == {0: None, 1: 0, 2: 1, 3: 0, 4: 0}


def test_containers_paths_and_labels(spark):
    marks = spark.createDataFrame([("w", "v1", 1, 4), ("w", "c1", 0, 6)], "work string, id string, pre_start int, pre_end int")
    nodes = spark.createDataFrame([("w", i) for i in range(7)], "work string, pre int")
    assert {r.pre: r.inside for r in publish.containers(marks, nodes).collect()}[2] == ["c1", "v1"]
    tree = spark.createDataFrame([("w", 0, 3, "a"), ("w", 1, 2, None), ("w", 2, 2, "b")], "work string, pre int, post int, id string")
    assert {r.id: r.path for r in publish.tree_paths(tree, "id").collect()} == {"a": "a", "b": "a/b"}
    toc = spark.createDataFrame([("w", 0, 1, "A"), ("w", 1, 2, "x"), ("w", 2, 2, "y"), ("w", 3, 1, "B"), ("w", 4, 2, "z")], "work string, pre int, level int, title string")
    assert {r.pre: r["items"] for r in publish.inline_toc(toc).collect()} == {0: "x | y", 3: "z"}


def test_figures_and_names(spark):
    figs = spark.createDataFrame([("a.png", False, 1, 1, 1), ("b.tif", True, 1, 1, 1), ("c.png", True, 500_000, 1, 1), ("d.gif", True, 300_000, 1, 1), ("e.jpg", True, 1, 2000, 2000), ("f.jpg", True, 1, 1, 1)], "path string, exists boolean, size long, w int, h int")
    assert {r.path: (r.severity, r.finding) for r in integrity.figure_findings(figs).collect()} == {"a.png": ("ERROR", "missing"), "b.tif": ("ERROR", "extension"), "c.png": ("ERROR", "size"), "d.gif": ("WARNING", "size"), "e.jpg": ("WARNING", "dimensions")}
    conf = spark.createDataFrame([("MAIN", "Abbr"), ("MAIN", "9x")], "section string, entry string")
    assert {(r.entry, r.finding) for r in integrity.name_findings(conf, "^[A-Z]\\w*$", ["Lang"]).collect()} == {("9x", "unknown name"), ("Lang", "missing")}


def test_image_probe(spark):
    png = b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + (7).to_bytes(4, "big") + (9).to_bytes(4, "big")
    gif = b"GIF89a" + (5).to_bytes(2, "little") + (6).to_bytes(2, "little")
    df = spark.createDataFrame([("p", bytearray(png)), ("g", bytearray(gif)), ("x", bytearray(b"no")), ("n", None)], "path string, content binary")
    assert {r.path: (r.format, r.w, r.h) for r in xml.image_probe(df).collect()} == {"p": ("png", 7, 9), "g": ("gif", 5, 6), "x": (None, None, None), "n": (None, None, None)}


def test_streams(spark, tmp_path):
    rows = spark.sql("SELECT * FROM VALUES (1, TIMESTAMP '2024-01-01 00:00:00'), (1, TIMESTAMP '2024-01-01 00:10:00'), (1, TIMESTAMP '2024-01-01 02:00:00'), (2, TIMESTAMP '2024-01-01 00:05:00'), (3, TIMESTAMP '2024-01-03 00:00:00') AS t(user_id, ts)")
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows.coalesce(1).write.parquet(src)
    stream = session_counts(spark.readStream.schema(rows.schema).parquet(src), "user_id", "ts")
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    closed = {(r.user_id, r.start): r.n for r in spark.read.parquet(out).collect()}
    whole = {(r.user_id, r.start): r.n for r in session_counts(rows, "user_id", "ts").collect()}
    assert closed and all(whole[k] == n for k, n in closed.items()) and len(whole) == 4
    told = rows.selectExpr("'E' AS severity", "'c' AS check", "CAST(user_id AS string) AS location", "'m' AS message", "ts")
    assert new_findings(told, "ts").count() == 3


def test_explicit_links_of_one_name(spark):
    marks = spark.range(20_000).select(F.col("id").alias("location"), F.lit("Ark").alias("lemma"), F.concat(F.lit("in C"), F.col("id") % 9).alias("before"))
    entries = spark.range(20_000).select((20_000 - F.col("id")).alias("entry"), F.lit("ark").alias("name"), F.concat(F.lit("c"), F.col("id") % 7).alias("context"))
    want = {i: min(e for e in range(1, 20_001) if i % 9 > 6 or (20_000 - e) % 7 == i % 9) for i in range(9)}
    began = time.time()
    got = quality.explicit_links(marks, entries).collect()
    assert len(got) == 20_000 and all(r.entry == want[r.location % 9] for r in got)
    assert time.time() - began < 60  # 400 million pairs before


def test_default_file_of_ties(spark):
    rows = [("a", p, 1.0) for p in (7, 3, 9, 5)] + [("a", 1, 2.0), ("a", 2, None), ("a", None, 0.5), ("b", 4, None)]
    for order in (rows, rows[::-1]):
        got = conf.default_file(spark.createDataFrame(order, "name string, path long, priority double").repartition(3)).collect()
        assert {r.name: r.path for r in got} == {"a": 3, "b": None}
