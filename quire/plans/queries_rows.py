"""Queries of the operators that read sources, build contents, restructure trees and render, on rows made from whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import integrity, order, packages, publish, quality, ranges, references, terms, verses
from quire.plans.queries import load, query
from quire.sources import commands, conf, html, xml


def text_of(*parts: str | Column) -> Column:
    """Columns and, in quotes of their own, literals as one text: strings are literals."""
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def turns(spark, d, **more: Column) -> DataFrame:
    """Conversations as nodes: work, pre, role, text."""
    c = load(spark, d, "conversations").select(F.col("conv_id").alias("work"), F.col("turn").alias("pre"), "role", "text")
    return c.withColumns(more) if more else c


TURNS = "SELECT conv_id AS work, turn AS pre, role, text FROM conversations"


def table_lines(df: DataFrame, key: str, text: Column) -> DataFrame:
    return commands.lines_of(df.select(F.col(key).alias("path"), text.alias("t")), "path", "t")


# sources -----------------------------------------------------------------------------------------------------------


@query("SELECT p_partkey AS path, 1 AS line_no, seq, marker, is_end, CASE seq WHEN 0 THEN p_size || ' ' || p_name WHEN 1 THEN p_brand ELSE '' END AS text, CASE WHEN seq = 1 THEN 'lemma=\"x\"' END AS attrs FROM part, (VALUES (0, 'v', false), (1, 'w', false), (2, 'w', true)) v(seq, marker, is_end)")
def marker_rows(spark, d):  # SC4
    p = load(spark, d, "part")
    return commands.markers(table_lines(p, "p_partkey", text_of("\\v ", F.col("p_size"), " ", F.col("p_name"), "\\w ", F.col("p_brand"), '|lemma="x"\\w*')), "path")


@query("SELECT p_partkey AS path, p_name AS id, p_brand AS h, CASE WHEN p_size % 2 = 0 THEN p_type END AS toc1 FROM part")
def file_facts(spark, d):  # SC2: what stands before the first chapter
    p = load(spark, d, "part")
    toc = F.when(F.col("p_size") % 2 == 0, text_of("\\toc1 ", F.col("p_type"))).otherwise("\\rem x")
    text = text_of("\\id ", F.col("p_name"), "\n\\h ", F.col("p_brand"), "\n", toc, "\n\\c 1\n\\toc1 late\n")
    return commands.file_facts(commands.markers(table_lines(p, "p_partkey", text), "path"), "path", ("id", "h", "toc1"))


@query("SELECT c_custkey, CASE WHEN c_nationkey = 3 THEN 'dictionary' WHEN c_nationkey IN (4, 5) THEN 'childrens' WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN 'bible' ELSE 'other' END AS kind FROM customer")
def file_types(spark, d):  # SC3
    ident = F.when(F.col("c_nationkey") == 3, "GLO x").when(F.col("c_nationkey") == 4, "my Child").when(F.col("c_nationkey") == 5, "CB 2").otherwise(F.col("c_mktsegment"))
    return commands.classify(load(spark, d, "customer").select("c_custkey", ident.alias("id")), spark.createDataFrame([("Bui",), ("aut",)], "code string")).select("c_custkey", "kind")


@query("SELECT s_suppkey AS path, line_no, command, CASE WHEN line_no = 2 THEN s_name END AS label, CASE line_no WHEN 2 THEN 'code ' || s_nationkey WHEN 4 THEN 'a: b' ELSE 'no command ' || s_suppkey END AS value FROM supplier, (VALUES (2, 'BOOK_NAME'), (4, 'FIX'), (5, '?')) v(line_no, command)")
def command_lines(spark, d):  # SC6, SC7
    s = load(spark, d, "supplier")
    text = text_of("# comment\nBOOK_NAME(", F.col("s_name"), "): code ", F.col("s_nationkey"), " \n\n  FIX: a: b\nno command ", F.col("s_suppkey"))
    return commands.commands(table_lines(s, "s_suppkey", text), "path")


@query("SELECT conv_id, turn, value, mode FROM (SELECT conv_id, turn, role, role || turn AS value, last_value(CASE WHEN role = 'user' THEN role || turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS mode FROM conversations) WHERE role <> 'user'")
def command_modes(spark, d):  # SC9
    c = load(spark, d, "conversations").select("conv_id", F.col("turn").alias("line_no"), F.when(F.col("role") == "user", "MODE").otherwise("RUN").alias("command"), F.concat("role", F.col("turn").cast("string")).alias("value"))
    return commands.with_mode(c, "conv_id").select("conv_id", F.col("line_no").alias("turn"), "value", "mode")


@query("""
SELECT 'MAIN' AS section, 'Title' AS entry, 0 AS seq, 'Main' || chr(10) || 'and more' AS value, 'conf/main.conf' AS src_file
UNION ALL SELECT 'MAIN', 'Last', 0, '1', 'conf/main.conf'
UNION ALL SELECT r_name, 'Name', 0, r_name, 'conf/r' || r_regionkey || '.conf' FROM region
UNION ALL SELECT r_name, 'Many', s, CAST(s + 1 AS VARCHAR), 'conf/r' || r_regionkey || '.conf' FROM region, (VALUES (0), (1)) v(s)""")
def conf_entries(spark, d):  # SC10, AL3: a file that includes one for each region; settings are small, the driver reads them
    regions = {r.r_regionkey: r.r_name for r in load(spark, d, "region").collect()}
    files = {"conf/main.conf": "Title=Main \\\nand more\n" + "".join(f"Include:r{k}.conf\n" for k in regions) + "Last=1\n"}
    files |= {f"conf/r{k}.conf": f"[{name}]\nName={name}\nOld=x\nOld=undef\nMany=1\nMany=2\n" for k, name in regions.items()}
    rows = conf.parse("conf/main.conf", files.__getitem__, ("Many",))
    return conf.settle(spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], conf.SCHEMA + ", line int"))


@query("SELECT s_suppkey AS path, line_no, kind, CASE line_no WHEN 1 THEN 'title,' || s_name WHEN 2 THEN 'unit,' || s_nationkey WHEN 4 THEN 'a,' || s_suppkey ELSE 'b,2' END AS raw FROM supplier, (VALUES (1, 'setting'), (2, 'setting'), (4, 'data'), (5, 'data')) v(line_no, kind)")
def preamble_tables(spark, d):  # SC11
    lines = table_lines(load(spark, d, "supplier"), "s_suppkey", text_of("title,", F.col("s_name"), "\nunit,", F.col("s_nationkey"), "\nterm,count\na,", F.col("s_suppkey"), "\nb,2"))
    settings, data = commands.with_preamble(lines, "path", F.col("raw") == "term,count")
    pick = lambda x, kind: x.select("path", "line_no", F.lit(kind).alias("kind"), "raw")
    return pick(settings, "setting").unionByName(pick(data, "data"))


@query("SELECT user_id, event_id AS line_no, CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'click' THEN 'WARNING' ELSE 'REPORT' END AS severity, props AS message FROM events WHERE event_type <> 'view'")
def log_findings(spark, d):  # SC12
    said = F.when(F.col("event_type") == "error", "ERROR").when(F.col("event_type") == "click", "WARNING").when(F.col("event_type") == "view", "Seen").otherwise("REPORT")
    lines = load(spark, d, "events").select("user_id", F.col("event_id").alias("line_no"), text_of("job", F.col("user_id"), " ", said, ": ", F.col("props")).alias("raw"))
    return commands.findings_from_log(lines, "user_id")


@query("SELECT o_orderkey, o_orderdate >= m AS is_fresh FROM orders JOIN (SELECT l_orderkey, max(l_shipdate) AS m FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey")
def fresh_builds(spark, d):  # SC15
    last = load(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("m"))
    return load(spark, d, "orders").join(last, "o_orderkey").select("o_orderkey", quality.is_fresh(F.col("o_orderdate"), [F.col("m")]).alias("is_fresh"))


@query("SELECT CAST(p_partkey AS VARCHAR) AS path, CASE p_partkey % 4 WHEN 0 THEN 'gif' WHEN 1 THEN 'png' WHEN 2 THEN 'jpeg' END AS format, CASE WHEN p_partkey % 4 < 3 THEN p_size END AS w, CASE WHEN p_partkey % 4 < 3 THEN p_size + 1 END AS h, CAST(CASE p_partkey % 4 WHEN 0 THEN 10 WHEN 1 THEN 24 WHEN 2 THEN 12 ELSE 3 END AS BIGINT) AS size FROM part")
def image_facts(spark, d):  # SC19: headers of images as many pixels wide as a part's size
    w, h = (lambda n: F.lpad(F.hex("p_size"), n, "0")), (lambda n: F.lpad(F.hex(F.col("p_size") + 1), n, "0"))
    gif = F.concat(F.lit("474946383961"), w(2), F.lit("00"), h(2), F.lit("00"))
    png = F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), w(8), h(8))
    jpeg = F.concat(F.lit("FFD8FFC0000B08"), h(4), w(4), F.lit("03"))
    k = F.col("p_partkey") % 4
    content = F.unhex(F.when(k == 0, gif).when(k == 1, png).when(k == 2, jpeg).otherwise("424D00"))
    return xml.image_probe(load(spark, d, "part").select(F.col("p_partkey").cast("string").alias("path"), content.alias("content")))


@query("SELECT CAST(g - 1 AS INTEGER) AS seq, substr(n_name, CAST(g AS INTEGER), 1) AS old, substr(lower(n_name), CAST(g AS INTEGER), 1) AS new FROM (SELECT n_name, unnest(generate_series(1, length(n_name))) AS g FROM nation)")
def char_pairs(spark, d):  # SC21
    return commands.replacement_chars(load(spark, d, "nation").select("n_name", F.lower("n_name").alias("low")), "n_name", "low")


@query("SELECT p_partkey AS path, line_no, CASE line_no WHEN 1 THEN p_name ELSE 'a' END AS old, CASE line_no WHEN 1 THEN p_brand ELSE p_type END AS new FROM part, (VALUES (1), (3)) v(line_no)")
def change_tables(spark, d):  # SC22
    return commands.change_table(table_lines(load(spark, d, "part"), "p_partkey", text_of('"', F.col("p_name"), "\" > '", F.col("p_brand"), "'\nc \"x\" > \"y\"\n  'a'>\"", F.col("p_type"), '"')), "path")


@query("SELECT dir, regexp_replace(dir, '^[0-9]+[ ._-]', '') AS name, CAST(coalesce(CASE WHEN dir LIKE '%-%' THEN split_part(dir, '-', 1) END, ord) AS INTEGER) AS place FROM (SELECT dir, CAST(min(ord) AS VARCHAR) AS ord FROM (SELECT CASE WHEN p_size % 2 = 0 THEN p_size || '-' || p_type ELSE p_type END AS dir, CASE upper(substr(p_name, 1, 3)) WHEN 'RED' THEN 1 WHEN 'BLU' THEN 2 WHEN 'OLD' THEN 3 END AS ord FROM part) GROUP BY dir)")
def discovered_publications(spark, d):  # SC20
    folder = F.when(F.col("p_size") % 2 == 0, F.concat_ws("-", F.col("p_size").cast("string"), "p_type")).otherwise(F.col("p_type"))
    files = load(spark, d, "part").select(F.concat_ws("/", F.lit("root"), folder, F.col("p_name")).alias("path"))
    return publish.sub_publications(files, "path", spark.createDataFrame([("RED", 1), ("BLU", 2), ("OLD", 3)], "code string, ord int"))


# sinks -------------------------------------------------------------------------------------------------------------


@query("SELECT CAST(conv_id AS VARCHAR) AS work, '<d>' || string_agg('<' || role || ' n=\"' || turn || '\"' || CASE WHEN text = '' THEN '/>' ELSE '>' || replace(replace(replace(replace(text, chr(13), ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</' || role || '>' END, '' ORDER BY turn) || '</d>' AS xml FROM conversations GROUP BY conv_id")
def serialised_works(spark, d):  # SK1: shredded and put together again
    esc = F.replace(F.replace(F.replace(F.replace("text", F.lit("\r"), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    one = text_of("<", F.col("role"), ' n="', F.col("turn"), '">', esc, "</", F.col("role"), ">")
    docs = load(spark, d, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", one.alias("x")))), lambda r: r["x"]), "").alias("b"))
    return xml.serialise(xml.shred(docs.select("conv_id", F.concat(F.lit("<d>"), "b", F.lit("</d>")).alias("xml")), "conv_id", "xml"))


@query("SELECT section, '[' || section || ']' || chr(10) || string_agg(entry || '=' || value, chr(10) ORDER BY entry) AS text FROM (SELECT 's' || (c_custkey // 100) AS section, 'c' || c_custkey AS entry, c_name AS value FROM customer WHERE c_nationkey >= 5) GROUP BY section")
def conf_text(spark, d):  # SK2: what differs from the defaults
    rows = lambda x: x.select(F.concat(F.lit("s"), F.floor(F.col("c_custkey") / 100).cast("string")).alias("section"), F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("entry"), F.lit(0).alias("seq"), F.col("c_name").alias("value"))
    c = load(spark, d, "customer")
    return conf.text_of(rows(c), rows(c.filter("c_nationkey < 5")))


@query("WITH n AS (SELECT c_custkey // 20 AS work, c_custkey % 20 AS pre, c_custkey % 20 + c_nationkey % 6 AS post, 'n' || c_nationkey AS id FROM customer WHERE c_nationkey <> 7) SELECT n.work, n.pre, string_agg(a.id, '/' ORDER BY a.pre) AS path FROM n JOIN n a ON a.work = n.work AND a.pre <= n.pre AND n.pre <= a.post GROUP BY n.work, n.pre")
def tree_keys(spark, d):  # SK6
    k = F.col("c_custkey")
    n = load(spark, d, "customer").select(F.floor(k / 20).alias("work"), (k % 20).alias("pre"), (k % 20 + F.col("c_nationkey") % 6).alias("post"), F.when(F.col("c_nationkey") != 7, F.concat(F.lit("n"), F.col("c_nationkey").cast("string"))).alias("id"))
    return publish.tree_paths(n, "id").select("work", "pre", "path")


@query("SELECT 'v' AS vsys, o_custkey AS book_ord, '<book id=\"B' || o_custkey || '\">' || string_agg('<chapter n=\"' || o_orderkey || '\" verses=\"' || vs || '\"/>', '' ORDER BY o_orderkey) || '</book>' AS xml FROM (SELECT o_custkey, o_orderkey, month(o_orderdate) AS vs FROM orders) GROUP BY o_custkey")
def canon_dumps(spark, d):  # SK10
    o = load(spark, d, "orders").select(F.lit("v").alias("vsys"), F.concat(F.lit("B"), F.col("o_custkey").cast("string")).alias("book"), F.col("o_custkey").alias("book_ord"), F.col("o_orderkey").alias("ch"), F.month("o_orderdate").alias("last_vs"))
    return publish.canon_dump(o)


@query("SELECT conv_id AS package, turn || '.txt' AS name, coalesce(text, '') AS text FROM conversations")
def zipped_files(spark, d):  # SK4, SK7: conversations as archives of a file for each turn, read again
    c = load(spark, d, "conversations").select("conv_id", text_of(F.col("turn"), ".txt").alias("name"), F.encode("text", "UTF-8").alias("content"))
    read = packages.unzipped(packages.archives(packages.zip_parts(c, "conv_id", "name", "content")))
    return read.select("package", "name", F.decode("content", "UTF-8").alias("text"))


@query("""
WITH f AS (SELECT o_custkey AS work, CAST(sum(o_orderkey) AS VARCHAR) AS size, max(CASE WHEN o_orderstatus = 'P' THEN 'Images' END) AS feature FROM orders GROUP BY 1), c AS (SELECT c_custkey AS work, c_name, c_nationkey % 2 = 0 AS k FROM customer)
SELECT work, 'Title' AS entry, 0 AS seq, c_name AS value, NULL AS finding FROM c UNION ALL SELECT work, 'Feature', 0, 'Old', NULL FROM c WHERE k UNION ALL SELECT work, 'InstallSize', 0, '1', NULL FROM c WHERE NOT k
UNION ALL SELECT work, 'InstallSize', CASE WHEN k THEN 0 ELSE 1 END, size, CASE WHEN NOT k THEN 'several values' END FROM f JOIN c USING (work)
UNION ALL SELECT work, 'Feature', CASE WHEN k THEN 1 ELSE 0 END, feature, NULL FROM f JOIN c USING (work) WHERE feature IS NOT NULL""")
def module_settings(spark, d):  # SK7
    c, even = load(spark, d, "customer"), F.col("c_nationkey") % 2 == 0
    one = lambda x, entry, value: x.select(F.col("c_custkey").alias("work"), F.lit(entry).alias("entry"), F.lit(0).alias("seq"), value.alias("value"))
    own = one(c, "Title", F.col("c_name")).unionByName(one(c.filter(even), "Feature", F.lit("Old"))).unionByName(one(c.filter(~even), "InstallSize", F.lit("1")))
    path = F.when(F.col("o_orderstatus") == "P", "images/x.PNG").otherwise("modules/x")
    files = load(spark, d, "orders").select(F.col("o_custkey").alias("work"), path.alias("path"), F.col("o_orderkey").alias("size"))
    derived = packages.install_facts(files).join(c.select(F.col("c_custkey").alias("work")), "work", "left_semi")
    return packages.module_settings(own, derived, ["Feature"])


@query("SELECT doc_id, replace(replace(replace(replace(text, 'e', '…'), '…', '...'), 'qu', 'kw'), 'kw', 'k') AS text FROM documents")
def phone_texts(spark, d):  # SK8
    marked = F.replace("text", F.lit("e"), F.lit("\u00ad…"))
    return load(spark, d, "documents").select("doc_id", packages.phone_text(marked, [("qu", "kw"), ("kw", "k")]).alias("text"))


@query("SELECT ch, count(*) AS n, min(doc_id) AS first FROM (SELECT doc_id, unnest(string_split(text, '')) AS ch FROM documents) WHERE unicode(ch) > 116 GROUP BY ch")
def high_chars(spark, d):  # SK8
    return packages.high_chars(load(spark, d, "documents"), "doc_id", "text", 116)


@query("""
WITH b AS (SELECT s_nationkey AS app, 'c' || (s_suppkey % 3) AS collection, s_suppkey AS place, 'B' || s_suppkey AS book, CASE WHEN s_suppkey % 2 = 0 THEN s_name END AS name FROM supplier),
c AS (SELECT app, collection, string_agg('Book: ' || book || chr(10), '' ORDER BY place) AS x FROM b GROUP BY ALL), t AS (SELECT app, string_agg('Book-Name-Map: ' || book || ', ' || name || chr(10), '' ORDER BY book || ', ' || name) AS names FROM b GROUP BY app)
SELECT app, coalesce(any_value(names), '') || string_agg(chr(10) || 'Collection: ' || collection || chr(10) || x, '' ORDER BY collection) AS text FROM c JOIN t USING (app) GROUP BY app""")
def collection_files(spark, d):  # SK8
    k = F.col("s_suppkey")
    name = F.when(k % 2 == 0, F.col("s_name"))
    return packages.collection_files(load(spark, d, "supplier").select(F.col("s_nationkey").alias("app"), text_of("c", k % 3).alias("collection"), k.alias("place"), text_of("B", k).alias("book"), name.alias("name")))


# filters and views -------------------------------------------------------------------------------------------------

NODES = "SELECT conv_id AS work, turn AS pre, CASE role WHEN 'user' THEN 'title' WHEN 'assistant' THEN 'figure' ELSE 'p' END AS name, CASE turn % 4 WHEN 1 THEN 'x-navmenu' WHEN 2 THEN 'x-duplicate' END AS type, turn % 3 = 0 AS bare FROM conversations"


@query(f"SELECT target, work, pre FROM ({NODES}), (VALUES ('module'), ('ebook'), ('text')) t(target) WHERE NOT coalesce(CASE target WHEN 'module' THEN type = 'x-navmenu' WHEN 'ebook' THEN type = 'x-duplicate' ELSE name = 'figure' END, false) AND NOT (name = 'title' AND bare)")
def target_removals(spark, d):  # F14, F24
    name = F.when(F.col("role") == "user", "title").when(F.col("role") == "assistant", "figure").otherwise("p")
    n = turns(spark, d, name=name, type=F.when(F.col("pre") % 4 == 1, "x-navmenu").when(F.col("pre") % 4 == 2, "x-duplicate"), text=F.when(F.col("pre") % 3 != 0, F.col("text")).otherwise(" "))
    one = lambda t: publish.removals(n, t).select(F.lit(t).alias("target"), "work", "pre")
    return one("module").unionByName(one("ebook")).unionByName(one("text"))


@query("SELECT which, o_orderkey, CASE which WHEN 'source' THEN 's' || o_custkey ELSE coalesce(CASE WHEN o_orderstatus = 'F' THEN 'f' || o_custkey END, 'i' || o_orderkey) END AS id FROM orders, (VALUES ('source'), ('fitted')) v(which) WHERE which = 'source' AND o_orderstatus <> 'P' OR which = 'fitted' AND o_orderstatus <> 'O'")
def system_views(spark, d):  # F15
    s, c = F.col("o_orderstatus"), F.col("o_custkey")
    n = load(spark, d, "orders").select("o_orderkey", F.when(s == "P", "fitted").when(s == "O", "source").alias("only_in"), text_of("s", c).alias("src_id"), F.when(s == "F", text_of("f", c)).alias("fitted_id"), text_of("i", F.col("o_orderkey")).alias("id"))
    one = lambda w: quality.view(n, w).select(F.lit(w).alias("which"), "o_orderkey", "id")
    return one("source").unionByName(one("fitted"))


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 AND p_size % 2 = 0 THEN 'x-right' END AS type, CASE WHEN p_size % 3 = 0 THEN CASE WHEN p_size % 2 = 0 THEN p_size || '.5' ELSE chr(160) END ELSE p_name END AS text FROM part")
def imported_nodes(spark, d):  # F16
    k = F.col("p_size") % 3
    cell = F.when(F.col("p_size") % 2 == 0, text_of(F.col("p_size"), ".5")).otherwise("  ")
    n = load(spark, d, "part").select("p_partkey", F.when(k == 0, "cell").when(k == 1, "k").otherwise("p").alias("name"), F.lit(None).cast("string").alias("type"), F.when(k == 0, cell).when(k == 1, text_of("(", F.col("p_name"), "), ")).otherwise(F.col("p_name")).alias("text"))
    return quality.imported(n).select("p_partkey", "type", "text")


# contents ----------------------------------------------------------------------------------------------------------

TOC = "SELECT c_custkey // 20 AS work, c_custkey % 20 AS pre, c_custkey % 20 + c_nationkey % 6 AS post, c_custkey % 7 = 0 AS told FROM customer WHERE c_nationkey % 3 > 0"


@query(f"WITH t AS ({TOC}) SELECT t.work, t.pre, CAST(least(CASE WHEN t.told THEN 2 ELSE 1 + (SELECT count(*) FROM t a WHERE a.work = t.work AND a.pre < t.pre AND t.pre <= a.post) END, 3) AS INTEGER) AS level FROM t")
def toc_levels(spark, d):  # WN12
    k = F.col("c_custkey")
    n = load(spark, d, "customer").select(F.floor(k / 20).alias("work"), (k % 20).alias("pre"), (k % 20 + F.col("c_nationkey") % 6).alias("post"), (F.col("c_nationkey") % 3 > 0).alias("is_toc"), F.when(k % 7 == 0, "[level2]x").otherwise("x").alias("text"))
    return publish.toc_levels(n).select("work", "pre", "level")


@query("""
WITH t AS (SELECT c_custkey // 50 AS work, c_custkey AS pre, CASE WHEN c_custkey % 50 >= 3 AND c_custkey % 11 > 0 THEN c_nationkey END AS book, c_custkey // 50 * 50 + 25 AS ch, c_acctbal < 0 AS gl FROM customer),
s AS (SELECT *, row_number() OVER (PARTITION BY work, book ORDER BY pre) AS n, min(CASE WHEN book IS NOT NULL THEN pre END) OVER (PARTITION BY work) AS st FROM t)
SELECT pre AS c_custkey, CASE WHEN gl THEN 'glossary' WHEN book IS NOT NULL AND n = 1 THEN 'book' WHEN book IS NOT NULL AND pre < ch THEN 'book intro' WHEN book IS NULL AND pre < st THEN 'whole intro' ELSE 'other' END AS role FROM s""")
def toc_roles(spark, d):  # WN14, AN16
    k = F.col("c_custkey")
    t = load(spark, d, "customer").select(F.floor(k / 50).alias("work"), k.alias("pre"), F.when((k % 50 >= 3) & (k % 11 > 0), F.col("c_nationkey")).alias("book"), (F.floor(k / 50) * 50 + 25).alias("first_chapter"), (F.col("c_acctbal") < 0).alias("in_glossary"))
    return publish.toc_roles(t).select(F.col("pre").alias("c_custkey"), "role")


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment WHEN c_custkey % 3 = 1 THEN c_name END AS toc_name FROM customer")
def toc_names(spark, d):  # AN16
    k = F.col("c_custkey") % 3
    b = load(spark, d, "customer").select("c_custkey", F.when(k == 0, text_of(" ", F.col("c_mktsegment"), " ")).otherwise(" ").alias("a"), F.when(k < 2, F.col("c_name")).alias("b"))
    return publish.toc_names(b, ["a", "b"]).select("c_custkey", "toc_name")


LEVELS = "SELECT conv_id AS work, turn AS pre, turn % 3 + 1 AS level, role || turn AS title FROM conversations"


@query(f"""
WITH t AS ({LEVELS}), e AS (SELECT t.*, (SELECT min(q.pre) FROM t q WHERE q.work = t.work AND q.pre > t.pre AND q.level <= t.level) AS until FROM t)
SELECT e.work, e.pre, string_agg(k.title, ' | ' ORDER BY k.pre) AS items FROM e JOIN t k ON k.work = e.work AND k.pre > e.pre AND k.level = e.level + 1 AND (e.until IS NULL OR k.pre < e.until) GROUP BY 1, 2""")
def inline_tocs(spark, d):  # AN18
    return publish.inline_toc(turns(spark, d, level=F.col("pre") % 3 + 1, title=F.concat("role", F.col("pre").cast("string"))).select("work", "pre", "level", "title"))


@query("SELECT work, pre, CAST(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY work ORDER BY pre ROWS UNBOUNDED PRECEDING) AS BIGINT) AS section FROM (" + TURNS + ")")
def toc_sections(spark, d):  # RD3
    return publish.sections(turns(spark, d), F.col("role") == "user").select("work", "pre", F.col("section").cast("long").alias("section"))


@query("SELECT p_partkey, n_scopes, CASE WHEN n_scopes > 1 THEN p_type END AS heading FROM part JOIN (SELECT p_brand, p_name, count(DISTINCT p_type) AS n_scopes FROM part GROUP BY 1, 2) USING (p_brand, p_name)")
def keyword_headings(spark, d):  # RD5
    p = order.distinct_order(load(spark, d, "part"), ["p_brand", "p_name"], "p_type", "n_scopes")
    return p.select("p_partkey", "n_scopes", F.when(F.col("n_scopes") > 1, F.col("p_type")).alias("heading"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber, l_partkey, l_suppkey) = 1 AS shows_chapter FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag FROM lineitem)")
def chapter_numbers(spark, d):  # RD7
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag").distinct()
    b = li.select("*", F.lit("w").alias("work"), F.col("l_orderkey").alias("book"), F.col("l_returnflag").alias("ch"), F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("pre"))
    return publish.chapter_numbers(b).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "shows_chapter")


@query("SELECT p_partkey, ['table', 'tr', 'td', 'ul', 'li', 'img', 'br', 'div', 'sup', 'h2', 'a'][p_partkey % 11 + 1] AS html, ['table', 'tr', 'td', 'table', 'tr', 'image', 'empty-line', 'v', 'a', 'subtitle', 'a'][p_partkey % 11 + 1] AS fb2 FROM part")
def table_tags(spark, d):  # RD10, RD12
    names = F.array(*map(F.lit, ("table", "row", "cell", "list", "item", "figure", "lb", "l", "note", "head", "reference")))
    name = F.get(names, (F.col("p_partkey") % 11).cast("int"))
    none = F.lit(None).cast("string")
    return load(spark, d, "part").select("p_partkey", publish.output_tag("html", name, none, F.lit(1)).alias("html"), publish.output_tag("fb2", name, none, F.lit(1)).alias("fb2"))


@query("SELECT work, pre, is_block, CAST(sum(CASE WHEN is_block IS DISTINCT FROM b THEN 1 ELSE 0 END) OVER (PARTITION BY work ORDER BY pre ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run FROM (SELECT *, lag(is_block) OVER (PARTITION BY work ORDER BY pre) AS b FROM (SELECT conv_id AS work, turn AS pre, length(text) % 3 = 0 AS is_block FROM conversations))")
def loose_runs(spark, d):  # RD14, RD17
    return publish.loose_runs(turns(spark, d), F.length("text") % 3 == 0).select("work", "pre", "is_block", F.col("run").cast("long").alias("run"))


HEADS = "SELECT conv_id AS work, turn AS pre, CASE WHEN turn % 2 = 0 THEN 'title' ELSE 'head' END AS name, CASE WHEN conv_id % 3 = 0 THEN 't' ELSE role END AS text FROM conversations"


@query(f"SELECT work, pre FROM (SELECT *, lag(name) OVER w AS n, lag(text) OVER w AS t FROM ({HEADS}) WINDOW w AS (PARTITION BY work ORDER BY pre)) WHERE NOT coalesce(name = 'head' AND n = 'title' AND t = text, false)")
def repeated_heads(spark, d):  # RD16
    n = turns(spark, d, name=F.when(F.col("pre") % 2 == 0, "title").otherwise("head"), text=F.when(F.col("work") % 3 == 0, "t").otherwise(F.col("role")))
    return publish.without_repeated_heads(n).select("work", "pre")


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_name WHEN p_size % 2 = 0 THEN p_type || ' - ' || p_name ELSE p_type || '(' || p_name END AS text FROM part".replace("'(' || p_name END", "'(' || p_name END").replace("WHEN p_size % 3 = 0 THEN p_name", "WHEN p_size % 3 = 0 THEN CASE WHEN p_size % 2 = 0 THEN p_name ELSE '(' || p_name END"))
def note_heads(spark, d):  # RD18
    n = load(spark, d, "part").select("p_partkey", F.when(F.col("p_size") % 3 != 0, F.col("p_type")).alias("heading"), F.when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise(text_of("(", F.col("p_name"))).alias("text"))
    return publish.note_heads(n).select("p_partkey", "text")


@query("SELECT o_orderkey AS id, CASE WHEN s_suppkey IS NULL THEN o_orderpriority WHEN s_nationkey % 2 = 0 THEN s_name || o_orderpriority ELSE s_name END AS body FROM orders LEFT JOIN supplier ON o_orderkey = s_suppkey")
def custom_menus(spark, d):  # RD21
    made = load(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("body"))
    own = load(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("body"), F.when(F.col("s_nationkey") % 2 == 0, "top").otherwise("all").alias("place"))
    return publish.custom_menus(made, own)


# verse systems -----------------------------------------------------------------------------------------------------

INST = "SELECT o_orderkey, 'B' || o_custkey AS book, 'C' || o_custkey AS other, o_orderkey % 40 + 1 AS ch, o_orderkey % 4 AS k FROM orders"


def _instructions(spark, d) -> DataFrame:
    k, book, other, ch = F.col("o_orderkey") % 4, text_of("B", F.col("o_custkey")), text_of("C", F.col("o_custkey")), F.col("o_orderkey") % 40 + 1
    moved = text_of("VSYS_MOVED: ", book, ".", ch, ".3.5 -> ", other, ".", ch, ".7.9")
    part = text_of("VSYS_FROM_TO: ", book, ".", ch, ".2.PART -> ", other, ".", ch, ".4")
    gone, wrong = text_of("VSYS_MISSING: ", book, ".", ch, ".3.4"), text_of("VSYS_MOVED: ", book, ".", ch, ".3.5 -> ", other, ".", ch, ".7.8")
    raw = F.when(k == 0, moved).when(k == 1, part).when(k == 2, gone).otherwise(wrong)
    # exploded, so that the lines are made once and not in each of the parser's patterns
    return verses.instructions(load(spark, d, "orders").select(F.col("o_orderkey").alias("line_no"), F.explode(F.array(raw)).alias("raw")))


@query(f"SELECT o_orderkey AS line_no, ['MOVED', 'FROM_TO', 'MISSING', 'MOVED'][k + 1] AS op, book, CAST(ch AS INTEGER) AS ch, [3, 2, 3, 3][k + 1] AS vs, [5, 2, 4, 5][k + 1] AS lv, k = 1 AS partial, k < 3 AS valid FROM ({INST})")
def instruction_rows(spark, d):  # VM10, VM1
    return _instructions(spark, d).select("line_no", "op", "book", "ch", "vs", "lv", "partial", "valid")


@query(f"SELECT book || '.' || ch || '.' || (3 + j) AS map_from, other || '.' || ch || '.' || (7 + j) AS map_to, false AS partial FROM ({INST}), (VALUES (0), (1), (2)) v(j) WHERE k = 0 UNION ALL SELECT book || '.' || ch || '.2', other || '.' || ch || '.4', true FROM ({INST}) WHERE k = 1")
def moved_verses(spark, d):  # VM6, VM4
    return verses.moved_map(_instructions(spark, d))


@query(f"SELECT o_orderkey AS line_no, row_number() OVER (PARTITION BY book ORDER BY CASE k WHEN 1 THEN 0 WHEN 2 THEN 4 ELSE 1 END, ch, o_orderkey) AS place FROM ({INST})")
def instruction_order(spark, d):  # ST10
    from quire.operators.sorting import placed

    return placed(_instructions(spark, d), ["book"], [*verses.instruction_order(), "line_no"]).select("line_no", "place")


@query("""
WITH v AS (SELECT DISTINCT l_orderkey AS ch, l_linenumber AS vs FROM lineitem), m AS (SELECT DISTINCT l_orderkey AS ch, l_linenumber + 1 AS vs FROM lineitem WHERE l_returnflag = 'R')
SELECT v.ch, v.vs, 'B.' || v.ch || '.' || v.vs || CASE WHEN m.vs IS NULL THEN '' ELSE ' B.' || v.ch || '.' || m.vs END AS ids FROM v LEFT JOIN m ON m.ch = v.ch AND m.vs = v.vs + 1""")
def joined_missing(spark, d):  # VM7
    li = load(spark, d, "lineitem").select(F.lit("B").alias("book"), F.col("l_orderkey").alias("ch"), F.col("l_linenumber").alias("vs"), "l_returnflag")
    v = li.select("book", "ch", "vs").distinct().withColumn("ids", F.array(F.concat_ws(".", "book", F.col("ch").cast("string"), F.col("vs").cast("string"))))
    gone = li.filter("l_returnflag = 'R'").select("book", "ch", (F.col("vs") + 1).alias("vs")).distinct()
    return verses.join_missing(v, gone).select("ch", "vs", F.array_join("ids", " ").alias("ids"))


@query("SELECT o_orderkey, item, CASE item WHEN 0 THEN 'Gen.' || ch || '.2-Gen.' || ch || '.' || l WHEN 1 THEN 'Exod.' || ch WHEN 2 THEN 'Gen.1.2-Gen.' || ch || '.3' ELSE 'what ' || ch END AS ref, item < 3 AS parsed FROM (SELECT o_orderkey, o_custkey % 50 + 1 AS ch, o_orderkey % 30 + 3 AS l FROM orders), (VALUES (0), (1), (2), (3)) v(item)")
def book_ranges(spark, d):  # RG10
    ch, last = F.col("o_custkey") % 50 + 1, F.col("o_orderkey") % 30 + 3
    o = load(spark, d, "orders").select("o_orderkey", text_of("GEN ", ch, ":2-", last, ", exo ", ch, "; GEN 1:2-", ch, ":3, what ", ch).alias("text"))
    return ranges.external_refs(o, "o_orderkey", "text", spark.createDataFrame([("GEN", "Gen"), ("EXO", "Exod")], "abbr string, book string"))


@query("SELECT c_custkey, n_regionkey AS grp, n_nationkey % 5 AS place FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def book_facts(spark, d):  # SF15
    n = load(spark, d, "nation").select(F.col("n_nationkey").alias("book"), F.col("n_regionkey").alias("grp"), (F.col("n_nationkey") % 5).alias("place"))
    return quality.book_facts(load(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("book")), "book", n).select("c_custkey", "grp", "place")


# texts -------------------------------------------------------------------------------------------------------------


def _upper(x: str) -> str:
    return x.upper()


@query("SELECT p_partkey, replace(upper(p_name), 'BOLT', 'bolt') AS name, upper(p_name) AS whole FROM part")
def transcoded_names(spark, d):  # SF21, UX3
    return load(spark, d, "part").select("p_partkey", publish.transcode(F.col("p_name"), _upper, "bolt").alias("name"), publish.transcode(F.col("p_name"), _upper).alias("whole"))


@query("SELECT p_partkey, CASE WHEN n < 1024 THEN n || ' B' WHEN n < 1048576 THEN format('{:,.1f}', n / 1024) || ' KB' ELSE format('{:,.1f}', n / 1048576) || ' MB' END AS said FROM (SELECT p_partkey, p_partkey * p_partkey * p_size AS n FROM part)")
def size_texts(spark, d):  # SF27
    return load(spark, d, "part").select("p_partkey", quality.size_text(F.col("p_partkey") * F.col("p_partkey") * F.col("p_size")).alias("said"))


@query("SELECT p_partkey, replace(p_name, 'bolt', '{{{bolt}}}') AS x0, CASE WHEN p_name LIKE 'small bolt' THEN 'a {{{small_bolt}}} b' ELSE 'a ' || p_name || ' b' END AS hidden, 'a ' || p_name || ' b' AS shown FROM part".replace("replace(p_name, 'bolt', '{{{bolt}}}') AS x0, ", ""))
def protected_texts(spark, d):  # AN5
    hidden = T.protect(text_of("a ", F.col("p_name"), " b"), "small bolt")
    return load(spark, d, "part").select("p_partkey", hidden.alias("hidden"), T.unprotect(hidden).alias("shown"))


@query("SELECT doc_id, substr(line, CAST(greatest(p - 40, 1) AS INTEGER), CAST(p - greatest(p - 40, 1) + 3 + 40 AS INTEGER)) AS found FROM (SELECT doc_id, line, instr(lower(line), 'ion') AS p FROM (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: contains(lower(x), 'ion'))[1] AS line FROM documents) WHERE line IS NOT NULL)")
def help_search(spark, d):  # AL6
    return quality.search(load(spark, d, "documents"), "doc_id", "text", "ION")


# annotators --------------------------------------------------------------------------------------------------------

BOOKS = {"Genesis": "Gen", "Exodus": "Exod"}


@query("""
WITH o AS (SELECT o_orderkey, o_orderkey % 12 AS k, 'Gen.' || (o_custkey % 50 + 1) AS c, o_orderkey % 30 + 1 AS v FROM orders)
SELECT o_orderkey, ['T01', 'T02', 'T03', 'T04', 'T05', 'T06', 'T07', 'T08', 'T09', 'T11', 'T12', 'T13'][k + 1] AS type,
 CASE WHEN k < 2 THEN c || '.' || v || '-' || c || '.' || (v + 2) WHEN k IN (2, 3, 9) THEN c || '.' || v WHEN k IN (4, 5, 8, 10) THEN c WHEN k = 6 THEN 'Gen.7.' || v || '-Gen.7.' || (v + 2) ELSE 'Gen.7.' || v END AS ref FROM o
UNION ALL SELECT o_orderkey, 'T10', c || '.' || (v + 5) FROM o WHERE k = 2""")
def ref_forms(spark, d):  # AN2: one phrase for each form, T01 to T13
    c, v = F.col("o_custkey") % 50 + 1, F.col("o_orderkey") % 30 + 1
    w = v + 2
    shapes = [
        text_of("Genesis ", c, ":", v, "-", c, ":", w), text_of("Genesis ", c, ":", v, "-", w), text_of("Genesis ", c, ":", v, ", ", v + 5), text_of("Genesis ", c, " chapter ", v, " verse"),
        text_of("Genesis ", c, "-", c + 1, " chapter"), text_of("Genesis ", c, " chapter"), text_of("Genesis ", v, "-", w, " verses"), text_of("Genesis ", v, " verse"),
        text_of("Genesis ", c), text_of("Genesis chapter ", c, " verse ", v), text_of("Genesis chapter ", c), text_of("Genesis verse ", v),
    ]
    said = F.get(F.array(*shapes), (F.col("o_orderkey") % 12).cast("int"))
    o = load(spark, d, "orders").select("o_orderkey", text_of("As in ", said, ". More").alias("text"), F.lit("Gen").alias("book"), F.lit(7).alias("ch"))
    got = references.link_references(o, "text", references.Settings(BOOKS), "book", "ch")
    return got.select("o_orderkey", F.explode("links").alias("x")).select("o_orderkey", "x.type", "x.ref")


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'Exod.' || ch || '.' || vs WHEN 1 THEN 'Gen.2.' || ch WHEN 2 THEN 'Gen.' || ch || '.' || vs END AS ref FROM (SELECT o_orderkey, o_custkey % 50 + 1 AS ch, o_orderkey % 30 + 1 AS vs FROM orders)")
def explicit_references(spark, d):  # AN3
    k, ch, vs = F.col("o_orderkey") % 4, F.col("o_custkey") % 50 + 1, F.col("o_orderkey") % 30 + 1
    text = F.when(k == 0, text_of(" ", vs)).when(k == 1, "here").when(k == 2, text_of("Genesis ", ch, ":", vs)).otherwise("nothing")
    o = load(spark, d, "orders").select("o_orderkey", text.alias("text"), F.when(k == 1, text_of("GEN 2:", ch)).alias("target"), F.lit("Exod").alias("book"), ch.cast("int").alias("ch"))
    return references.explicit_references(o, "text", "target", references.Settings(BOOKS), {"GEN": "Gen", "EXO": "Exod"}, "book", "ch").select("o_orderkey", "ref")


@query("SELECT o_orderkey, CASE WHEN ch = 3 AND vs = 4 THEN 'Exod.4.3' ELSE 'Gen.' || ch || '.' || vs END AS ref FROM (SELECT o_orderkey, o_custkey % 9 + 1 AS ch, o_orderkey % 8 + 1 AS vs FROM orders) WHERE NOT (ch = 5 AND vs = 6)")
def fixed_references(spark, d):  # AN4
    ch, vs = F.col("o_custkey") % 9 + 1, F.col("o_orderkey") % 8 + 1
    fixes = spark.createDataFrame([("Genesis 3:4", "Exodus 4:3"), ("Genesis 5:6", "")], "found string, instead string")
    got = references.link_references(load(spark, d, "orders").select("o_orderkey", text_of("see Genesis ", ch, ":", vs, " there").alias("text")), "text", references.Settings(BOOKS), fixes=fixes)
    return got.select("o_orderkey", F.explode("links").alias("x")).select("o_orderkey", "x.ref")


@query("SELECT c_custkey AS location, 'Gen 1' AS found FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def unused_fixes(spark, d):  # AN4: fixes that no link at their place used
    fixes = load(spark, d, "customer").select(F.col("c_custkey").alias("location"), F.lit("Gen 1").alias("found"), F.lit("").alias("instead"))
    return references.fix_report(fixes, load(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("location"), F.lit("Gen 1").alias("text"))).select("location", "found")


@query("""
WITH e AS (SELECT s_suppkey AS entry, 'n' || s_nationkey AS name, 'k' || (s_suppkey % 7) AS ctx FROM supplier),
m AS (SELECT c_custkey, 'n' || c_nationkey AS name, 'k' || (c_custkey % 7) || ' and k' || (c_custkey % 3) || ' of' AS before FROM customer),
h AS (SELECT c_custkey, entry, CASE WHEN contains(before, ctx) THEN length(before) - instr(reverse(before), reverse(ctx)) ELSE -1 END AS p FROM m LEFT JOIN e USING (name))
SELECT c_custkey AS location, entry FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY p DESC, entry) AS n FROM h) WHERE n = 1""")
def explicit_links(spark, d):  # AN8
    k = F.col("c_custkey")
    marks = load(spark, d, "customer").select(k.alias("location"), text_of("N", F.col("c_nationkey")).alias("lemma"), text_of("k", k % 7, " and k", k % 3, " of").alias("before"))
    entries = load(spark, d, "supplier").select(F.col("s_suppkey").alias("entry"), text_of("n", F.col("s_nationkey")).alias("name"), text_of("K", F.col("s_suppkey") % 7).alias("context"))
    return quality.explicit_links(marks, entries).select("location", "entry")


@query("SELECT p_partkey, CASE WHEN p_name LIKE '% bolt' THEN 'Bolt' ELSE 'Other' END AS entry, CASE WHEN p_name LIKE '% bolt' THEN 'bolt' ELSE split_part(p_name, ' ', 1) END AS text FROM part WHERE p_name LIKE '% bolt' OR p_name LIKE '% gear' OR p_name LIKE '% ring'")
def rule_matches(spark, d):  # AN9, AN7: quoted text, a flag, and a group named link
    rules = [terms.Rule("Bolt", "D:Bolt", "/\\QBOLT\\E/i"), terms.Rule("Other", "D:Other", "/(?'link'\\w+) (?:gear|ring)/")]
    p = load(spark, d, "part").select("p_partkey", F.lit(1).cast("long").alias("seq"), F.col("p_name").alias("text"), F.lit(None).cast("string").alias("atom"), F.lit(None).cast("string").alias("testament"), F.lit(False).alias("in_keyword"))
    return terms.link_terms(p, rules, ["p_partkey"]).select("p_partkey", "entry", "text")


@query("SELECT conv_id, min(turn) AS seq, 'la' AS text FROM conversations WHERE role <> 'system' AND regexp_matches(text, '(^|[^\\w\\x{80}-\\x{10FFFF}])la([^\\w\\x{80}-\\x{10FFFF}]|$)') GROUP BY conv_id")
def first_terms(spark, d):  # AN6, WN2, F13: a rule links once in a context, and not in contexts that it excludes
    c = load(spark, d, "conversations").select("conv_id", F.col("turn").alias("seq"), "text", F.col("role").alias("atom"), F.lit("OT").alias("testament"), F.lit(False).alias("in_keyword"))
    return terms.link_terms(c, [terms.Rule("La", "D:La", r"/\b(la)\b/", not_context=frozenset({"system"}))], ["conv_id"]).select("conv_id", "seq", "text")


@query("SELECT p_partkey, 'n' || p_size AS note, 1 AS mark_seq, CASE WHEN p_size % 2 = 0 THEN 4 END AS body_seq FROM part UNION ALL SELECT p_partkey, 'x' || p_size, NULL, 4 FROM part WHERE p_size % 2 = 1")
def note_pairs(spark, d):  # AN14
    size = F.col("p_size")
    page = text_of('<html><head><title>x</title></head><body><a href="#n', size, '">1</a><p id="', F.when(size % 2 == 0, "n").otherwise("x"), size, '">note</p></body></html>')
    return html.note_pairs(html.html_events(load(spark, d, "part").select("p_partkey", page.alias("html")), "p_partkey", "html"), "p_partkey")


@query("""
SELECT p_partkey, seq, kind, name, CASE seq WHEN 1 THEN 'class=' || p_type WHEN 2 THEN p_name WHEN 5 THEN p_brand ELSE '' END AS value FROM part, (VALUES (0, 'start', 'body'), (1, 'start', 'p'), (2, 'text', 'p'), (3, 'start', 'b'), (4, 'start', 'i'),
 (5, 'text', 'b+i+p'), (6, 'end', 'i'), (7, 'end', 'b'), (8, 'end', 'p'), (9, 'start', 'script'), (10, 'end', 'script'), (11, 'end', 'body')) v(seq, kind, name)""")
def html_runs(spark, d):  # SC16, AN13: comments, scripts and what is outside the body are passed over
    page = text_of('<html><head><title>x</title></head><body><p class="', F.col("p_type"), '">', F.col("p_name"), "<!-- y --> <b><i> ", F.col("p_brand"), "</i></b></p><script>var z;</script></body></html>")
    return html.html_events(load(spark, d, "part").select("p_partkey", page.alias("html")), "p_partkey", "html")


@query("""
WITH t AS (SELECT user_id AS book, event_id AS t FROM events WHERE event_type = 'view'), v AS (SELECT user_id AS book, event_id AS id, event_id AS pre, event_id + 900 AS until FROM events WHERE event_type = 'click')
SELECT v.book, v.id, min(t.t) AS insert_at FROM v LEFT JOIN t ON t.book = v.book AND t.t > v.pre AND t.t <= v.until GROUP BY 1, 2""")
def insertion_points(spark, d):  # AN19
    e = load(spark, d, "events").select(F.col("user_id").alias("book"), F.col("event_id").alias("pre"), "event_type")
    nodes = e.select("book", "pre", F.lit("text").alias("kind"), F.when(F.col("event_type") == "view", "x").otherwise(" ").alias("text"))
    marks = e.filter("event_type = 'click'").select("book", F.col("pre").alias("id"), "pre", (F.col("pre") + 900).alias("until"))
    return quality.insertion_points(nodes, marks)


@query("SELECT c_custkey AS work, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END AS Owner, c_name AS Title, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment || '. ' ELSE '' END || c_name AS statement FROM customer")
def copyright_statements(spark, d):  # AN20, AN21
    c = load(spark, d, "customer")
    one = lambda x, entry, value: x.select(F.col("c_custkey").alias("work"), F.lit(entry).alias("entry"), F.col(value).alias("value"))
    rows = one(c, "Title", "c_name").unionByName(one(c.filter("c_custkey % 3 > 0"), "Owner", "c_mktsegment")).unionByName(one(c, "Other", "c_name"))
    return publish.copyright_lines(rows, ["Owner", "Title"])


# trees -------------------------------------------------------------------------------------------------------------


@query("""
WITH m AS (SELECT conv_id AS work, role || turn AS id, turn AS a, turn + 2 + turn % 2 AS b FROM conversations WHERE role = 'user')
SELECT c.conv_id AS work, c.turn AS pre, string_agg(m.id, ' ' ORDER BY m.a) AS inside FROM conversations c LEFT JOIN m ON m.work = c.conv_id AND c.turn > m.a AND c.turn < m.b GROUP BY 1, 2""")
def milestone_containers(spark, d):  # TR2, D3
    n = turns(spark, d)
    marks = n.filter("role = 'user'").select("work", F.concat("role", F.col("pre").cast("string")).alias("id"), F.col("pre").alias("pre_start"), (F.col("pre") + 2 + F.col("pre") % 2).alias("pre_end"))
    return publish.containers(marks, n.select("work", "pre")).select("work", "pre", F.array_join("inside", " ").alias("inside"))


@query("""
WITH c AS (SELECT conv_id AS work, turn AS pre, conv_id % 3 AS k FROM conversations),
s AS (SELECT work, pre, pre AS major, 1 AS minor, NULL AS copy_of FROM c WHERE pre <> 1 OR k = 2
 UNION ALL SELECT work, pre, 0, 0, CASE WHEN k = 2 THEN substr(md5(work || ':1:1'), 1, 4) END FROM c WHERE pre = 1 AND k > 0)
SELECT work, pre, copy_of, CAST(row_number() OVER (PARTITION BY work ORDER BY major, minor, pre) - 1 AS INTEGER) AS new_pre FROM s""")
def placed_subtrees(spark, d):  # TR4
    n = turns(spark, d).select("work", "pre")
    k = F.col("work") % 3
    told = n.filter("pre = 1").select("work", F.when(k == 0, "remove").when(k == 1, "move").otherwise("copy").alias("action"), F.lit(1).alias("pre_lo"), F.lit(1).alias("pre_hi"), F.lit(0).alias("before"))
    return publish.place(n, told).select("work", "pre", "copy_of", "new_pre")


@query("WITH n AS (SELECT conv_id AS work, turn AS pre, role, CASE WHEN turn = 0 THEN NULL WHEN turn <= 2 THEN 0 ELSE 1 END AS parent FROM conversations) SELECT work, pre, CASE WHEN parent = 1 AND max(CASE WHEN role = 'user' AND pre > 2 THEN 1 ELSE 0 END) OVER (PARTITION BY work, parent ORDER BY pre ROWS UNBOUNDED PRECEDING) = 1 THEN 0 ELSE parent END AS parent FROM n")
def cut_siblings(spark, d):  # TR7
    n = turns(spark, d, parent=F.when(F.col("pre") == 0, None).when(F.col("pre") <= 2, 0).otherwise(1)).select("work", F.col("pre").cast("int").alias("pre"), "role", "parent")
    return quality.cut_siblings(n, (F.col("role") == "user") & (F.col("pre") > 2)).select("work", F.col("pre").cast("long").alias("pre"), "parent")


@query("""
WITH e AS (SELECT p_partkey // 100 AS work, p_partkey AS pre, p_name AS title, upper(substr(p_name, 1, 1)) AS l FROM part WHERE p_size % 10 > 0)
SELECT pre AS p_partkey, CAST(row_number() OVER w AS INTEGER) AS place, CASE WHEN lag(l) OVER w IS NOT DISTINCT FROM l THEN NULL ELSE l END AS heading FROM e WINDOW w AS (PARTITION BY work ORDER BY title, pre)""")
def combined_glossaries(spark, d):  # TR8, ST5
    e = load(spark, d, "part").select(F.floor(F.col("p_partkey") / 100).alias("work"), F.col("p_partkey").alias("pre"), F.col("p_name").alias("title"), F.when(F.col("p_size") % 10 == 0, "x-duplicate").when(F.col("p_size") % 10 == 1, "x-aggregate").alias("type"))
    return publish.combined_glossary(e, F.col("title")).select(F.col("pre").alias("p_partkey"), "place", "heading")


# findings ----------------------------------------------------------------------------------------------------------


@query("SELECT c.conv_id || ':' || c.turn AS location, c.role || ' in ' || p.role AS message FROM conversations c JOIN conversations p ON p.conv_id = c.conv_id AND p.turn = c.turn - 1 WHERE NOT (p.role = 'user' AND c.role = 'assistant') AND c.role || ' in ' || p.role <> 'user in system'")
def schema_findings(spark, d):  # DQ3
    n = turns(spark, d).select("work", "pre", F.lit("element").alias("kind"), F.col("role").alias("name"), F.when(F.col("pre") > 0, F.col("pre") - 1).alias("parent"))
    return quality.schema_findings(n, spark.createDataFrame([("user", "assistant")], "parent string, child string"), ["user in system"]).select("location", "message")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS location, CAST(o_custkey AS VARCHAR) AS message FROM orders WHERE o_orderstatus <> 'P' AND o_custkey NOT IN (SELECT s_suppkey FROM supplier)")
def context_findings(spark, d):  # DQ6
    rules = load(spark, d, "orders").select(F.col("o_orderkey").alias("rule"), F.when(F.col("o_orderstatus") == "P", "All").otherwise(F.col("o_custkey").cast("string")).alias("value"))
    return quality.context_findings(rules, load(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("id"))).select("location", "message")


@query("SELECT 'ERROR' AS severity, CAST(p_partkey AS VARCHAR) AS location, p_type AS message FROM part WHERE p_type IN ('SMALL', 'PROMO') UNION ALL SELECT 'WARNING', CAST(p_partkey AS VARCHAR), p_name FROM part WHERE p_type = 'LARGE' AND p_size % 2 = 0")
def rule_findings(spark, d):  # DQ7
    p = load(spark, d, "part").select(F.col("p_partkey").alias("rule"), F.when(F.col("p_type") == "LARGE", "osisRef").otherwise(F.col("p_type")).alias("attribute"), F.when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise(text_of("W:", F.col("p_name"))).alias("value"))
    return quality.rule_findings(p, ("osisRef", "STANDARD", "MEDIUM", "ECONOMY")).select("severity", "location", "message")


@query("SELECT c_mktsegment AS section, c_name AS entry, 'unknown name' AS finding FROM customer WHERE c_name NOT LIKE '%0_' UNION ALL SELECT NULL, 'Owner', 'missing'")
def name_findings(spark, d):  # DQ9
    c = load(spark, d, "customer").select(F.col("c_mktsegment").alias("section"), F.col("c_name").alias("entry"))
    return integrity.name_findings(c, "^Customer#\\d+0\\d$", ("Customer#000000001", "Owner"))


@query("SELECT c_custkey, 'x' || lower(c_name) AS name FROM customer")
def hooked_rows(spark, d):  # UX1
    registry = {"preprocess": [lambda x: x.withColumn("name", F.lower("name")), lambda x: x.withColumn("name", F.concat(F.lit("x"), "name"))], "postprocess": [lambda x: x.filter("false")]}
    return publish.hooks(load(spark, d, "customer").select("c_custkey", F.col("c_name").alias("name")), registry, "preprocess")


@query("SELECT doc_id, k, CASE k WHEN 0 THEN true ELSE false END AS valid FROM documents, (VALUES (0), (1), (2)) v(k)")
def utf8_check(spark, d):  # SF28: whole texts, texts with a stray byte behind them, and texts cut within a character
    data = F.encode("text", "UTF-8")
    odd = F.array(data, F.concat(data, F.unhex(F.lit("FF"))), F.concat(data, F.unhex(F.lit("E282"))))
    return load(spark, d, "documents").select("doc_id", F.posexplode(odd).alias("k", "b")).select("doc_id", "k", T.is_utf8(F.col("b")).alias("valid"))
