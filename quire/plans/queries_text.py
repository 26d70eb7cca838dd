"""Queries of text functions, sorts, annotators, publications, verse systems and graphs."""

from __future__ import annotations

import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import integrity, order, paths, publish, quality, ranges, references, sorting, terms, verses
from quire.plans import graph
from quire.plans.queries import load, query
from quire.sources import commands, conf, xml

# scalar functions --------------------------------------------------------------------------------------------------


@query("SELECT p_partkey, array_to_string(list_transform(string_split(p_name || '_' || p_brand, ''), lambda c: CASE WHEN regexp_matches(c, '^[A-Za-z0-9]$') THEN c ELSE '_' || unicode(c) || '_' END), '') AS id FROM part")
def encode_id(spark, d):  # SF1
    return load(spark, d, "part").select("p_partkey", T.encode_ref(F.concat_ws("_", "p_name", "p_brand")).alias("id"))


@query("SELECT p_partkey, p_name || '_' || p_brand AS name FROM part")
def roundtrip_id(spark, d):  # SF1, SF2
    return load(spark, d, "part").select("p_partkey", T.decode_ref(T.encode_ref(F.concat_ws("_", "p_name", "p_brand"))).alias("name"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'W' END AS work, p_name AS rest FROM part")
def split_prefix(spark, d):  # SF3, SF23
    work, rest = T.split_ref(F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("W:"), "p_name")).otherwise(F.col("p_name")))
    return load(spark, d, "part").select("p_partkey", work.alias("work"), rest.alias("rest"))


@query("SELECT p_partkey, CASE WHEN regexp_matches(x, '^[A-Za-z_]') THEN x ELSE 'id_' || x END AS id FROM (SELECT p_partkey, replace(replace(p_partkey || p_brand, '#', 'x35'), ' ', 'x32') AS x FROM part)")
def xml_ids(spark, d):  # SF4
    return load(spark, d, "part").select("p_partkey", T.xml_id(F.concat(F.col("p_partkey").cast("string"), "p_brand")).alias("id"))


@query("SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ') AS title, upper(substr(p_name, 1, 1)) || lower(substr(p_name, 2)) AS sentence, upper(replace(p_name, 'i', 'İ')) AS capitals FROM part")
def title_case(spark, d):  # SF5, SF6
    n = F.col("p_name")
    return load(spark, d, "part").select("p_partkey", T.title_case(n, 1).alias("title"), T.title_case(n, 2).alias("sentence"), T.upper_with(n, [("i", "İ")]).alias("capitals"))


@query("SELECT p_partkey, '[' || p_type || '][x]' AS given, p_type || '|x' AS told, p_name AS title FROM part")
def title_instructions(spark, d):  # SF7
    given = F.concat(F.lit("["), "p_type", F.lit("][x]"))
    told, title = T.instructions(F.concat(given, "p_name"))
    return load(spark, d, "part").select("p_partkey", given.alias("given"), F.array_join(told, "|").alias("told"), title.alias("title"))


@query("SELECT doc_id, nfc_normalize(text) = text AS same, length(nfc_normalize(text)) AS n FROM documents")
def normalise_nfc(spark, d):  # SF8
    x = load(spark, d, "documents").select("doc_id", "text", T.normalise("NFC")(F.col("text")).alias("nfc"))
    return x.select("doc_id", (F.col("nfc") == F.col("text")).alias("same"), F.length("nfc").cast("long").alias("n"))


@query("SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text, substr(md5(text), 1, 4) AS short FROM documents")
def squeezed(spark, d):  # SF9, SF10
    return load(spark, d, "documents").select("doc_id", T.squeeze(F.col("text")).alias("text"), T.short_md5(F.col("text")).alias("short"))


@query("SELECT p_partkey, p_name AS text, p_brand AS brand, CAST(p_size AS VARCHAR) AS size FROM part")
def attribute_parse(spark, d):  # SF11
    text, m = T.attributes(F.concat("p_name", F.lit('|brand="'), "p_brand", F.lit('" size="'), F.col("p_size").cast("string"), F.lit('"')))
    return load(spark, d, "part").select("p_partkey", text.alias("text"), m["brand"].alias("brand"), m["size"].alias("size"))


@query("SELECT p_partkey, a || upper(substr(b, 1, 1)) || substr(b, 2) AS camel, lower(p_name) AS root FROM (SELECT *, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b FROM part)")
def name_forms(spark, d):  # SF12, SF14
    return load(spark, d, "part").select("p_partkey", T.camel(F.replace("p_name", F.lit(" "), F.lit("-"))).alias("camel"), T.root_id(F.concat(F.lit("W:"), "p_name", F.lit(".dup12"))).alias("root"))


@query("SELECT l_orderkey, l_linenumber, 'Line ' || l_linenumber || ':' || a || CASE WHEN b = a THEN '' ELSE '-' || b END AS said FROM (SELECT *, l_suppkey + 1 AS a, l_suppkey + 1 + l_partkey % 3 AS b FROM lineitem)")
def local_references(spark, d):  # SF13
    one = lambda v: F.struct(F.col("l_linenumber").alias("ch"), v.alias("vs"))
    a = F.col("l_suppkey") + 1
    return load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", T.local_reference(F.lit("Line"), one(a), one(a + F.col("l_partkey") % 3)).alias("said"))


@query("SELECT count(*) FILTER (ok) AS n_valid, count(*) FILTER (NOT ok) AS n_wrong FROM (SELECT l_linenumber > 0 AND (l_partkey % 5 = 0 OR l_suppkey % 7 > l_partkey % 7) AS ok FROM lineitem)")
def valid_ranges(spark, d):  # SF16
    last = F.when(F.col("l_partkey") % 5 != 0, F.col("l_suppkey") % 7)
    ok = T.valid_range(F.lit("B"), F.col("l_linenumber"), F.col("l_partkey") % 7, last)
    return load(spark, d, "lineitem").select(ok.alias("ok")).agg(F.count_if("ok").alias("n_valid"), F.count_if(~F.col("ok")).alias("n_wrong"))


@query("SELECT p_partkey, replace(replace(p_name, 'e', 'ea'), 'a', 'o') AS fast, translate(p_name, 'aeiou', 'AEIOU') AS simple FROM part")
def replacements(spark, d):  # SF18, SF19 fast, SF20
    return load(spark, d, "part").select("p_partkey", T.replace_table(F.col("p_name"), [("e", "ea"), ("a", "o")]).alias("fast"), T.simplify(F.col("p_name"), ("aeiou", "AEIOU")).alias("simple"))


@query("SELECT p_partkey, replace(replace(replace(p_name, 'e', chr(1)), 'a', 'o'), chr(1), 'ea') AS strict FROM part")
def strict_replacements(spark, d):  # SF19 strict
    return load(spark, d, "part").select("p_partkey", T.replace_once([("e", "ea"), ("a", "o")])(F.col("p_name")).alias("strict"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN '#x' ELSE '../b/' || p_partkey || '.html#x' END AS href, 'a/c' AS short FROM part")
def relative_paths(spark, d):  # SF22, SF29
    name = F.concat(F.col("p_partkey").cast("string"), F.lit(".html"))
    target = F.concat(F.when(F.col("p_partkey") % 3 == 0, "root/a/").otherwise("root/b/"), name, F.lit("#x"))
    return load(spark, d, "part").select("p_partkey", T.relative_path(F.concat(F.lit("root/a/"), name), target).alias("href"), T.shorten_path(F.lit("a/b/../c")).alias("short"))


@query("SELECT p_partkey, replace(p_brand || ':<a>', ':', '%58') AS x0, replace(replace(replace(p_brand || ':<a>', '<', '%60'), '>', '%62'), ':', '%58') AS file_name, p_brand || ':<a>' AS back, replace(replace(p_brand || ':<a>', '<', '&#60;'), '>', '&#62;') AS attribute FROM part".replace("replace(p_brand || ':<a>', ':', '%58') AS x0, ", ""))
def codecs(spark, d):  # SF29
    raw = F.concat("p_brand", F.lit(":<a>"))
    return load(spark, d, "part").select("p_partkey", T.escape_file_name(raw).alias("file_name"), T.unescape_file_name(T.escape_file_name(raw)).alias("back"), T.escape_attribute(raw).alias("attribute"))


@query("SELECT p_partkey, 'x ' || lower(p_type) AS class, CASE p_size % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE -1 END AS nth FROM part")
def class_and_ordinal(spark, d):  # SF24, SF25
    word = F.when(F.col("p_size") % 3 == 0, "First").when(F.col("p_size") % 3 == 1, "second").otherwise("LAST")
    return load(spark, d, "part").select("p_partkey", T.css_class(F.lit("x"), F.lit(None), F.lit(""), F.lower("p_type")).alias("class"), T.ordinal(word).alias("nth"))


@query("SELECT doc_id, length(regexp_replace(text, 'on|the', '', 'g')) AS n, regexp_matches(text, 'on|the') AS hit FROM documents")
def alternation_match(spark, d):  # SF26, UX6
    pattern = T.alternation(["on", "the"])
    return load(spark, d, "documents").select("doc_id", F.length(F.regexp_replace("text", pattern, "")).cast("long").alias("n"), F.col("text").rlike(pattern).alias("hit"))


# sorts -------------------------------------------------------------------------------------------------------------


@query("SELECT p_partkey, row_number() OVER (ORDER BY translate(k, 'SMLR', 'ABCD'), p_partkey) AS place FROM (SELECT p_partkey, p_brand, regexp_replace(upper(p_name), '[^A-Z0-9 ]', '', 'g') AS k FROM part)".replace("ORDER BY", "PARTITION BY p_brand ORDER BY"))
def collation_sort(spark, d):  # ST2, ST3, ST5
    key = T.sort_key(F.col("p_name"), ["S", "M", "L", "R"])
    w = Window.partitionBy("p_brand").orderBy(key, "p_partkey")
    return load(spark, d, "part").select("p_partkey", F.row_number().over(w).cast("long").alias("place"))


@query("SELECT p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_name, p_partkey) AS by_count, row_number() OVER (PARTITION BY p_brand ORDER BY length(p_name) DESC, p_name, p_partkey) AS by_length FROM part")
def count_and_length_sorts(spark, d):  # ST4, ST8, ST12, ST14
    p = sorting.placed(load(spark, d, "part"), ["p_brand"], sorting.by_count("p_size", "p_name", "p_partkey"), "by_count")
    return sorting.placed(p, ["p_brand"], sorting.by_length("p_name", "p_partkey"), "by_length").select("p_partkey", "by_count", "by_length")


@query("SELECT p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY CASE WHEN bool_and THEN p_size ELSE 0 END, CASE WHEN bool_and THEN '' ELSE p_name END, p_partkey) AS place FROM (SELECT *, bool_and(p_size > 9) OVER (PARTITION BY p_brand, p_type) AS bool_and FROM part)")
def numeric_keyword_sort(spark, d):  # ST6: numeric only where all keys of a group are
    p, keys = sorting.keyword_order(load(spark, d, "part"), ["p_brand", "p_type"], "p_name", F.col("p_size"), F.col("p_size") > 9)
    return sorting.placed(p, ["p_brand"], [*keys, "p_partkey"]).select("p_partkey", "place")


@query("SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END, CASE WHEN c_custkey % 4 = 0 THEN -c_custkey ELSE c_custkey END) AS place FROM customer")
def cover_order(spark, d):  # ST7, ST9, ST11: OT reversed, then the rest
    keys = sorting.canon_order(F.col("c_mktsegment") == "BUILDING", F.when(F.col("c_custkey") % 4 == 0, -F.col("c_custkey")).otherwise(F.col("c_custkey")))
    return sorting.placed(load(spark, d, "customer"), ["c_nationkey"], keys).select("c_custkey", "place")


@query("SELECT l_orderkey, l_linenumber, l_suppkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, l_partkey) AS place FROM lineitem")
def address_sort(spark, d):  # ST1, D4
    a = F.concat_ws(".", F.concat(F.lit("W:B"), F.col("l_orderkey").cast("string")), F.col("l_linenumber").cast("string"), F.col("l_suppkey").cast("string"))
    li = load(spark, d, "lineitem").withColumn("book_ord", F.lit(1)).withColumn("a", a)
    w = Window.partitionBy("l_orderkey").orderBy(*ranges.address_order(F.col("a")), "l_partkey")
    return li.select("l_orderkey", "l_linenumber", "l_suppkey", F.row_number().over(w).cast("long").alias("place"))


@query("SELECT o_custkey, min(o_orderkey) AS first_pub, max(o_orderkey) AS last_pub FROM orders GROUP BY 1")
def publication_choice(spark, d):  # ST13
    return sorting.chosen(load(spark, d, "orders"), ["o_custkey"], "o_orderkey")


# annotators --------------------------------------------------------------------------------------------------------

BOOKS = {"Genesis": "Gen", "Jude": "Jude", "Psalms": "Ps"}


@query("SELECT o_orderkey, 'Gen.' || ch || '.' || vs AS ref, 'T03' AS type FROM (SELECT o_orderkey, o_custkey % 50 + 1 AS ch, o_orderkey % 30 + 1 AS vs FROM orders) UNION ALL SELECT o_orderkey, 'Gen.' || ch || '.' || (vs + 2) || '-Gen.' || ch || '.' || (vs + 4), 'T10' FROM (SELECT o_orderkey, o_custkey % 50 + 1 AS ch, o_orderkey % 30 + 1 AS vs FROM orders)")
def ref_extract(spark, d):  # AN1, AN2, WN3, UX8: phrases made from orders' numbers
    ch, vs = F.col("o_custkey") % 50 + 1, F.col("o_orderkey") % 30 + 1
    said = F.format_string("see Genesis %d:%d, %d-%d and so on", ch, vs, vs + 2, vs + 4)
    got = references.link_references(load(spark, d, "orders").select("o_orderkey", said.alias("text")), "text", references.Settings(BOOKS))
    return got.select("o_orderkey", F.explode("links").alias("x")).select("o_orderkey", "x.ref", "x.type")


PLANTED = (
    ("T01", "Genesis {c}:{v}-{d}:{w}", "Gen.{c}.{v}"), ("T02", "Genesis {c}:{v}-{w}", "Gen.{c}.{v}-Gen.{c}.{w}"), ("T03", "Genesis {c}:{v}", "Gen.{c}.{v}"),
    ("T04", "Genesis {c} chapter {v}-{w} verses", "Gen.{c}.{v}-Gen.{c}.{w}"), ("T05", "Genesis {c}-{d} chapter", "Gen.{c}"), ("T06", "Genesis {c} chapter", "Gen.{c}"),
    ("T07", "Jude {v}-{w} verses", "Jude.1.{v}-Jude.1.{w}"), ("T08", "Jude {v} verse", "Jude.1.{v}"), ("T09", "Genesis {c}", "Gen.{c}"), ("T10", "Genesis {c}:{v}, {w}", "Gen.{c}.{w}"),
    ("T11", "Genesis chapter {c} verse {v}", "Gen.{c}.{v}"), ("T12", "Genesis chapter {c}", "Gen.{c}"), ("T13", "Jude verse {v}", "Jude.1.{v}"),
)


def _planted(i: int, k: int) -> str:
    """A shape as SQL over a document's numbers."""
    return " || ".join(f"'{x}'" if n % 2 == 0 else x for n, x in enumerate(re.split("[{}]", PLANTED[i][k])) if x)


def _by_form(k: int) -> str:
    return "CASE doc_id % 13 " + " ".join(f"WHEN {i} THEN {_planted(i, k)}" for i in range(13)) + " END"


@query(f"""
SELECT doc_id, CAST(place + CASE WHEN doc_id % 13 = 9 THEN length(said) - length(w || '') ELSE 0 END AS INTEGER) AS start, CASE WHEN doc_id % 13 = 9 THEN w || '' ELSE said END AS text, ['{"', '".join(t for t, _, _ in PLANTED)}'][doc_id % 13 + 1] AS type, ref
 FROM (SELECT doc_id, w, CAST(length(coalesce(text, '')) // 2 + 6 AS INTEGER) AS place, {_by_form(1)} AS said, {_by_form(2)} AS ref FROM (SELECT doc_id, text, doc_id % 49 + 1 AS c, doc_id % 49 + 2 AS d, doc_id % 20 + 1 AS v, doc_id % 20 + 3 AS w FROM documents))
UNION ALL SELECT doc_id, CAST(length(coalesce(text, '')) // 2 + 6 AS INTEGER), 'Genesis ' || (doc_id % 49 + 1) || ':' || (doc_id % 20 + 1), 'T03', 'Gen.' || (doc_id % 49 + 1) || '.' || (doc_id % 20 + 1) FROM documents WHERE doc_id % 13 = 9""")
def ref_prose(spark, d):  # AN1, AN2: a reference of each form in the middle of every document; numbers of the prose have no book
    n = F.col("doc_id")
    numbers = {"c": n % 49 + 1, "d": n % 49 + 2, "v": n % 20 + 1, "w": n % 20 + 3}
    said = [F.concat(*(F.lit(x) if i % 2 == 0 else numbers[x].cast("string") for i, x in enumerate(re.split("[{}]", shape)) if x)) for _, shape, _ in PLANTED]
    half, text = F.floor(F.length(F.coalesce("text", F.lit(""))) / 2).cast("int"), F.coalesce("text", F.lit(""))
    docs = load(spark, d, "documents").select("doc_id", F.concat(F.substring(text, F.lit(1), half), F.lit(" . Lo "), F.element_at(F.array(*said), (n % 13 + 1).cast("int")), F.lit(" lo "), F.substring(text, half + 1, F.length(text))).alias("text"))
    got = references.link_references(docs, "text", references.Settings(BOOKS))
    return got.select("doc_id", F.explode("links").alias("x")).filter("x.status = 'ok'").select("doc_id", F.col("x.start").alias("start"), "x.text", "x.type", "x.ref")


@query()
def ref_extract_documents(spark, d):  # AN1 on whole documents: prose with numbers, context book given
    docs = load(spark, d, "documents").select("doc_id", "text", F.lit("Gen").alias("book"), F.lit(1).alias("ch"))
    got = references.link_references(docs, "text", references.Settings(BOOKS | {"The": "The", "De": "De"}), "book", "ch")
    return got.select("doc_id", F.explode("links").alias("x")).select("doc_id", "x.*")


@query(r"""
WITH c AS (SELECT conv_id, turn AS seq, text, role FROM conversations WHERE role <> 'system'),
r(entry, ref, pat, only_user, not_assistant) AS (VALUES ('House', 'D:House', 'house\S*', false, false), ('The', 'D:The', 'the', true, false), ('Est', 'D:Est', '(?-i:est|from)', false, true)),
m AS (SELECT conv_id, seq, entry, ref, text, '(?is)^((?:.*?[^\p{L}\p{N}_])??)(' || pat || ')' || CASE WHEN entry = 'House' THEN '' ELSE '(?:[^\p{L}\p{N}_]|$)' END AS p FROM c, r WHERE (NOT only_user OR role = 'user') AND (NOT not_assistant OR role <> 'assistant')),
f AS (SELECT *, length(regexp_extract(text, p, 1)) AS b, regexp_extract(text, p, 2) AS t FROM m WHERE regexp_matches(text, p))
SELECT conv_id, seq, CAST(b AS INTEGER) AS start, CAST(b + length(t) AS INTEGER) AS "end", entry, ref, t AS text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, entry ORDER BY seq) AS n FROM f) WHERE n = 1""")
def term_link(spark, d):  # AN6, AN7, WN2, F13
    rules = [terms.Rule("House", "D:House", r"/\b(house\S*)/i"), terms.Rule("The", "D:The", r"/\b(the)\b/i", multiple="match", context=frozenset({"user"})), terms.Rule("Est", "D:Est", r"/\b(est|from)\b/", not_context=frozenset({"assistant"})), terms.Rule("In", "D:In", r"/\b(in)\b/", dont_link=True)]
    c = load(spark, d, "conversations").select("conv_id", F.col("turn").alias("seq"), "text", F.col("role").alias("atom"), F.lit("OT").alias("testament"), (F.col("role") == "system").alias("in_keyword"))
    return terms.link_terms(c, rules, ["conv_id"])


@query(r"""
WITH t AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS w FROM benchmark),
d AS (SELECT doc_id, string_split_regex(text, '[\p{L}\p{N}_]+') AS gaps, regexp_extract_all(text, '[\p{L}\p{N}_]+') AS ws FROM documents WHERE text <> ''),
u AS (SELECT doc_id, unnest(ws) AS w, unnest(gaps[1:len(ws)]) AS gap, generate_subscripts(ws, 1) AS i FROM d),
p AS (SELECT doc_id, w, CAST(sum(length(gap) + length(w)) OVER (PARTITION BY doc_id ORDER BY i) - length(w) AS INTEGER) AS b FROM u)
SELECT doc_id, w AS entry, min(b) AS start FROM p WHERE w IN (SELECT w FROM t WHERE length(w) >= 5) GROUP BY doc_id, w""")
def many_terms(spark, d):  # AN6, AN9: a rule for each longer word of the benchmark, on all documents
    said = load(spark, d, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit("[\\p{L}\\p{N}_]+"), F.lit(0))).alias("w")).distinct().filter("length(w) >= 5").orderBy("w")
    rules = [terms.Rule(r.w, f"D:{r.w}", f"/\\b(\\Q{r.w}\\E)\\b/", multiple="match") for r in said.collect()]  # the rule table
    docs = load(spark, d, "documents").select("doc_id", F.lit(0).cast("long").alias("seq"), "text", F.lit(None).cast("string").alias("atom"), F.lit(None).cast("string").alias("testament"), F.lit(False).alias("in_keyword"))
    return terms.link_terms(docs, rules, ["doc_id"]).select("doc_id", "entry", "start")


@query("SELECT DISTINCT p_name AS entry, unnest(list_distinct(list_concat([p_name || ', ' || p_type], [p_name, p_type]))) AS variant FROM part")
def default_rules(spark, d):  # AN10
    e = load(spark, d, "part").select(F.concat_ws(", ", "p_name", "p_type").alias("k"), F.col("p_name")).distinct()
    return terms.default_rules(e, "k").select(F.regexp_replace("entry", ", [A-Z]+$", "").alias("entry"), "variant").distinct()


@query("SELECT p_partkey, CASE WHEN p_size > 40 OR length(p_name) <= 8 THEN '/\\b(\\Q' || p_name || '\\E\\b)/' ELSE '/\\b(\\Q' || p_name || '\\E\\S*)/' END || CASE WHEN p_type = 'ECONOMY' THEN '' ELSE 'i' END AS pattern FROM part")
def tightened_rules(spark, d):  # AG17, SK13
    r = load(spark, d, "part").select("p_partkey", F.col("p_name").alias("variant"), F.col("p_size").alias("n"), F.when(F.col("p_type") == "ECONOMY", "B").otherwise("A").alias("tier"), F.concat(F.lit("/\\b(\\Q"), "p_name", F.lit("\\E\\S*)/i")).alias("pattern"))
    return terms.tighten(r, 8, 40).select("p_partkey", "pattern")


@query("""
WITH m AS (SELECT conv_id, turn, w, trim(regexp_replace(replace(text, w, '*' || w || '*'), '\\s+', ' ', 'g')) AS x FROM (SELECT conv_id, turn, text, regexp_extract(text, '^([^ .,]+)', 1) AS w FROM conversations))
SELECT conv_id, turn, CASE WHEN length(x) > 256 THEN coalesce(list_filter(string_split(regexp_replace(x, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda s: contains(s, '*' || w || '*'))[1], x) ELSE x END AS sample FROM m""")
def term_samples(spark, d):  # AN12
    return load(spark, d, "conversations").select("conv_id", "turn", T.context_sample(F.col("text"), F.regexp_extract("text", "^([^ .,]+)", 1)).alias("sample"))


@query("SELECT l_orderkey AS verse, o.ordinal, o.mention_at, f.note_id FROM (SELECT l_orderkey, l_linenumber AS at, l_partkey AS note_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS nth FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey FROM lineitem GROUP BY 1, 2)) f JOIN (SELECT o_orderkey, CAST(o_orderkey % 3 + 1 AS INTEGER) AS ordinal, 9 AS mention_at FROM orders) o ON l_orderkey = o_orderkey AND nth = o.ordinal")
def footnote_links(spark, d):  # AN11, JN15
    notes = load(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("verse"), F.col("l_linenumber").alias("at")).agg(F.min("l_partkey").alias("note_id"))
    m = load(spark, d, "orders").select(F.col("o_orderkey").alias("verse"), (F.col("o_orderkey") % 3 + 1).cast("int").alias("ordinal"), F.lit(9).alias("at"))
    return references.footnote_links(notes, m, "verse").select("verse", "ordinal", "mention_at", "note_id")


# verse systems -----------------------------------------------------------------------------------------------------


@query("""
WITH v AS (SELECT o_custkey AS b, o_orderkey AS ch, unnest(generate_series(1, 8)) AS vs FROM orders),
m AS (SELECT *, ch % 3 = 0 AND vs BETWEEN 3 AND 4 AS gone, CASE WHEN ch % 3 = 0 AND vs > 4 THEN -2 WHEN ch % 3 = 1 AND vs >= 5 THEN 1 ELSE 0 END AS sh FROM v),
s AS (SELECT *, last_value(CASE WHEN NOT gone THEN vs + sh END IGNORE NULLS) OVER (PARTITION BY ch ORDER BY vs) AS sv FROM m)
SELECT 'B' || b || '.' || ch || '.' || vs AS fixed_id, 'B' || b || '.' || ch || '.' || sv AS src_id, CASE WHEN gone THEN 'missing' WHEN sv = vs THEN 'same' ELSE 'moved' END AS status FROM s""")
def verse_maps(spark, d):  # VM1-VM5, VM8, D10
    o = load(spark, d, "orders").select(F.concat(F.lit("B"), F.col("o_custkey").cast("string")).alias("book"), F.col("o_orderkey").cast("int").alias("ch"))
    idx = o.select("*", F.explode(F.sequence(F.lit(1), F.lit(8))).alias("vs"))
    raw = o.filter("ch % 3 < 2").select(F.col("ch").alias("line_no"), F.when(F.col("ch") % 3 == 0, F.format_string("VSYS_MISSING: %s.%d.3.4", "book", "ch")).otherwise(F.format_string("VSYS_EXTRA: %s.%d.5", "book", "ch")).alias("raw"))
    return verses.verse_maps(idx, verses.instructions(raw)).select("fixed_id", "src_id", "status")


@query("""
WITH c AS (SELECT 'B' || o_custkey AS b, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS ch, o_orderkey AS k FROM orders),
v AS (SELECT b, ch, k, unnest(generate_series(1, 4 + k % 5)) AS vs FROM c),
s AS (SELECT *, (vs = 3 AND k % 3 = 0) OR (vs = 4 AND k % 7 = 0) AS split, vs BETWEEN 1 AND 2 AND k % 4 = 1 AS gone FROM v),
g AS (SELECT *, ch + sum(CASE WHEN split THEN 1 ELSE 0 END) OVER (PARTITION BY b ORDER BY ch, vs) AS sc FROM s),
p AS (SELECT *, row_number() OVER (PARTITION BY b, sc ORDER BY ch, vs) AS place FROM g WHERE NOT gone),
x AS (SELECT b, ch AS sc, 2 AS sv FROM c WHERE k % 5 = 2),
n AS (SELECT b, sc, n, row_number() OVER (PARTITION BY b, sc ORDER BY n) AS place FROM (SELECT DISTINCT b, sc FROM p), (SELECT unnest(generate_series(1, 40)) AS n) WHERE (b, sc, n) NOT IN (SELECT b, sc, sv FROM x)),
m AS (SELECT p.b, p.ch, p.vs, p.sc, n.n AS sv FROM p JOIN n ON n.b = p.b AND n.sc = p.sc AND n.place = p.place),
a AS (SELECT g.b, g.ch, g.vs, gone, m.sc, m.sv FROM g LEFT JOIN m ON m.b = g.b AND m.ch = g.ch AND m.vs = g.vs),
near AS (SELECT b, ch, vs, gone, coalesce(last_value(CASE WHEN sv IS NOT NULL THEN sc || '.' || sv END IGNORE NULLS) OVER (PARTITION BY b, ch ORDER BY vs),
 first_value(CASE WHEN sv IS NOT NULL THEN sc || '.' || sv END IGNORE NULLS) OVER (PARTITION BY b, ch ORDER BY vs ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS said FROM a),
line AS (SELECT b, sc, sv, b || '.' || ch || '.' || vs AS id FROM m UNION ALL SELECT b, sc, sv, NULL FROM x),
host AS (SELECT b, sc, sv, id, coalesce(last_value(id IGNORE NULLS) OVER (PARTITION BY b ORDER BY sc, sv), first_value(id IGNORE NULLS) OVER (PARTITION BY b ORDER BY sc, sv ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS h FROM line)
SELECT b || '.' || ch || '.' || vs AS fixed_id, b || '.' || said AS src_id, CASE WHEN gone THEN 'missing' WHEN said = ch || '.' || vs THEN 'same' ELSE 'moved' END AS status,
 CASE WHEN NOT gone AND said <> ch || '.' || vs THEN '(' || CASE WHEN split_part(said, '.', 1) <> ch || '' THEN split_part(said, '.', 1) || ':' ELSE '' END || split_part(said, '.', 2) || ')' END AS alt_label FROM near
UNION ALL SELECT h, b || '.' || sc || '.' || sv, 'extra', NULL FROM host WHERE id IS NULL""")
def split_verse_maps(spark, d):  # VM1-VM3, VM5, VM8, D10
    n = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    c = load(spark, d, "orders").select(F.concat(F.lit("B"), F.col("o_custkey").cast("string")).alias("book"), F.row_number().over(n).alias("ch"), F.col("o_orderkey").alias("k"))
    idx = c.select("book", "ch", F.explode(F.sequence(F.lit(1), (4 + F.col("k") % 5).cast("int"))).alias("vs"))
    said = lambda when, shape: F.when(when, F.format_string(shape, "book", "ch"))
    k = F.col("k")
    lines = F.array(said(k % 3 == 0, "VSYS_CHAPTER_SPLIT_AT: %s.%d.3"), said(k % 7 == 0, "VSYS_CHAPTER_SPLIT_AT: %s.%d.4"), said(k % 4 == 1, "VSYS_MISSING: %s.%d.1.2"), said(k % 5 == 2, "VSYS_EXTRA: %s.%d.2"))
    raw = c.select(k.alias("line_no"), F.explode(lines).alias("raw")).filter("raw IS NOT NULL")
    return verses.verse_maps(idx, verses.instructions(raw), extra=True).select("fixed_id", "src_id", "status", "alt_label")


@query("""
WITH m AS (SELECT c_custkey AS a, c_custkey + 7 AS b FROM customer WHERE c_nationkey > 11), i AS (SELECT c_custkey AS ord FROM customer),
r AS (SELECT DISTINCT k, ord FROM (SELECT o_orderkey AS k, coalesce(m.b, x.v) AS ord FROM (SELECT o_orderkey, unnest(generate_series(o_custkey, o_custkey + 3)) AS v FROM orders) x LEFT JOIN m ON m.a = x.v) JOIN i USING (ord)),
g AS (SELECT k, min(ord) AS lo, max(ord) AS hi FROM (SELECT k, ord, ord - row_number() OVER (PARTITION BY k ORDER BY ord) AS g FROM r) GROUP BY k, g)
SELECT k, string_agg(CASE WHEN lo = hi THEN 'V.' || lo ELSE 'V.' || lo || '-V.' || hi END, ' ' ORDER BY lo) AS refs FROM g GROUP BY k""")
def retargeted_refs(spark, d):  # JN7, VM9, RG3
    ident = lambda c: F.concat(F.lit("V."), c.cast("string"))
    c = load(spark, d, "customer")
    maps = c.filter("c_nationkey > 11").select(ident(F.col("c_custkey")).alias("map_from"), ident(F.col("c_custkey") + 7).alias("map_to"))
    refs = load(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.explode(F.sequence("o_custkey", F.col("o_custkey") + 3)).alias("v")).select("k", ident(F.col("v")).alias("id"))
    return verses.retarget(refs, maps, "k", c.select(ident(F.col("c_custkey")).alias("id"), F.col("c_custkey").alias("ord")))


@query("SELECT a.c_custkey AS map_from, coalesce(b.t, a.c_custkey + 1) AS map_to FROM customer a LEFT JOIN (SELECT c_custkey AS f, c_custkey * 2 AS t FROM customer WHERE c_custkey % 2 = 0) b ON a.c_custkey + 1 = b.f")
def composed_map(spark, d):  # JN8
    c = load(spark, d, "customer")
    first = c.select(F.col("c_custkey").alias("map_from"), (F.col("c_custkey") + 1).alias("map_to"))
    return verses.compose(first, c.filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("map_from"), (F.col("c_custkey") * 2).alias("map_to")))


# publications ------------------------------------------------------------------------------------------------------


@query("""
WITH p(pub_id, lo, hi) AS (VALUES ('a', 0, 4), ('b', 3, 9)),
k AS (SELECT pub_id, c_mktsegment AS work, c_custkey AS pre, CASE WHEN c_nationkey < 20 THEN c_nationkey END AS book FROM customer JOIN p ON c_nationkey >= 20 OR c_nationkey BETWEEN lo AND hi),
f AS (SELECT pub_id, work, arg_min(book, pre) AS first FROM k WHERE book IS NOT NULL GROUP BY 1, 2)
SELECT k.pub_id, pre, coalesce(book = first, false) AS is_first_book FROM k LEFT JOIN f USING (pub_id, work)""")
def publication_scope(spark, d):  # F6, F7, TR1
    n = load(spark, d, "customer").select(F.col("c_mktsegment").alias("work"), F.col("c_custkey").alias("pre"), F.when(F.col("c_nationkey") < 20, F.col("c_nationkey")).alias("book"))
    pubs = spark.createDataFrame([("a", list(range(5))), ("b", list(range(3, 10)))], "pub_id string, books array<int>")
    return publish.by_scope(n, pubs).select("pub_id", "pre", "is_first_book")


@query("SELECT p_brand AS div, p_brand IN (SELECT p_brand FROM part WHERE p_size = 7) AS is_kept FROM part GROUP BY p_brand")
def glossary_scope(spark, d):  # F8
    divs = load(spark, d, "part").groupBy(F.col("p_brand").alias("div")).agg(F.collect_set("p_size").alias("scopes"))
    return publish.glossary_by_scope(divs, spark.createDataFrame([(7,)], "book int")).select("div", "is_kept")


@query("SELECT p_partkey, CASE WHEN n = 1 THEN NULL ELSE p_name END AS title FROM (SELECT p_partkey, p_name, count(*) OVER (PARTITION BY p_name, p_brand) AS n FROM part WHERE p_size < 10)")
def subentry_scope(spark, d):  # F9
    p = load(spark, d, "part").select(F.concat("p_name", "p_brand").alias("entry"), F.col("p_partkey").alias("sub"), F.col("p_size").alias("scope"), F.col("p_name").alias("title"))
    return publish.subentries_by_scope(p, spark.createDataFrame([(i,) for i in range(10)], "book int")).select(F.col("sub").alias("p_partkey"), "title")


@query("SELECT o_orderkey, replace(replace('W:' || o_orderkey || ' X:' || o_custkey || ' W:z', ' W:', ' '), 'W:', '') AS refs, CAST(2 AS INTEGER) AS n_removed FROM orders")
def prefix_removal(spark, d):  # F21
    o = load(spark, d, "orders").select("o_orderkey", F.concat(F.lit("W:"), F.col("o_orderkey").cast("string"), F.lit(" X:"), F.col("o_custkey").cast("string"), F.lit(" W:z")).alias("refs"))
    return publish.without_prefix(o, "refs", "W").select("o_orderkey", "refs", "n_removed")


@query("SELECT l_orderkey, l_linenumber, CASE WHEN p_partkey IS NOT NULL THEN 'reference' WHEN l_linenumber = 1 THEN 'hi' END AS name FROM lineitem LEFT JOIN (SELECT p_partkey FROM part WHERE p_size > 10) ON l_partkey = p_partkey")
def demoted_references(spark, d):  # F19, F20, JN14
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("ref"), F.lit("reference").alias("name"), F.when(F.col("l_linenumber") == 1, "annotateRef").alias("type"))
    return publish.without_references(li, load(spark, d, "part").filter("p_size > 10").select(F.col("p_partkey").alias("id"))).select("l_orderkey", "l_linenumber", "name")


@query("SELECT conv_id AS work, turn AS pre, CASE role WHEN 'user' THEN 'h' || (turn % 3 + 1) WHEN 'assistant' THEN 'p' END AS tag FROM conversations WHERE role IN ('user', 'assistant', 'system')")
def output_tags(spark, d):  # RD1, RD2, RD8, RD9
    c = load(spark, d, "conversations").filter("role IN ('user', 'assistant', 'system')")
    name = F.when(F.col("role") == "user", "title").when(F.col("role") == "assistant", "p").otherwise("header")
    return c.select(F.col("conv_id").alias("work"), F.col("turn").alias("pre"), publish.output_tag("html", name, F.lit(None).cast("string"), (F.col("turn") % 3 + 1)).alias("tag"))


@query("SELECT o_custkey AS work, CAST(o_orderkey AS BIGINT) AS pre, CASE WHEN n THEN (o_orderkey % 20) || '-' || (o_orderkey % 20 + 1) ELSE CAST(o_orderkey % 20 AS VARCHAR) END AS label FROM (SELECT *, o_orderkey % 4 = 0 AS n FROM orders)")
def verse_labels(spark, d):  # RD6
    v = F.col("o_orderkey") % 20
    ident = lambda x: F.concat(F.lit("B.1."), x.cast("string"))
    o = load(spark, d, "orders").select(F.col("o_custkey").alias("work"), F.col("o_orderkey").alias("pre"), F.when(F.col("o_orderkey") % 4 == 0, F.array(ident(v), ident(v + 1))).otherwise(F.array(ident(v))).alias("ids"))
    return publish.verse_labels(o).select("work", "pre", "label")


@query("SELECT file, kind, string_agg(n || ' ' || t, chr(10) ORDER BY pre) AS body FROM (SELECT conv_id AS file, role AS kind, turn AS pre, text AS t, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS n FROM conversations) GROUP BY 1, 2")
def note_bodies(spark, d):  # RD13
    return publish.note_bodies(load(spark, d, "conversations").select(F.col("conv_id").alias("file"), F.col("role").alias("kind"), F.col("turn").alias("pre"), "text"))


@query("SELECT o_orderkey, CASE WHEN n = 1 THEN 'f' || s_nationkey || '#' || t END AS href, CASE WHEN n IS NULL THEN 'missing' WHEN n > 1 THEN 'several' END AS finding FROM (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'B' || o_custkey WHEN 1 THEN 'B' || o_custkey || '.1' ELSE 'B' || o_custkey || '.1.1' END AS ref, 'B' || o_custkey || '.1.1' AS t FROM orders) o LEFT JOIN (SELECT id, min(s_nationkey) AS s_nationkey, count(*) AS n FROM (SELECT 'B' || s_suppkey || '.1.1' AS id, s_nationkey FROM supplier UNION ALL SELECT 'B5.1.1', 5) GROUP BY id) ON t = id")
def link_targets(spark, d):  # RD15, RD19, JN18
    b = F.concat(F.lit("B"), F.col("o_custkey").cast("string"))
    refs = load(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, b).when(F.col("o_orderkey") % 3 == 1, F.concat(b, F.lit(".1"))).otherwise(F.concat(b, F.lit(".1.1"))).alias("ref"))
    ids = load(spark, d, "supplier").select(F.concat(F.lit("B"), F.col("s_suppkey").cast("string"), F.lit(".1.1")).alias("id"), F.concat(F.lit("f"), F.col("s_nationkey").cast("string")).alias("file"))
    return publish.link_targets(refs, ids.unionByName(spark.createDataFrame([("B5.1.1", "f5")], "id string, file string"))).select("o_orderkey", "href", "finding")


@query("SELECT work, pre, CASE WHEN NOT nt THEN k || '_' || row_number() OVER (PARTITION BY work, k, nt ORDER BY pre) END AS file FROM (SELECT conv_id AS work, turn AS pre, CASE role WHEN 'user' THEN 'ch' WHEN 'assistant' THEN 'kw' ELSE 'ot' END AS k, turn % 5 = 4 AS nt FROM conversations)")
def section_files(spark, d):  # RD20, SK3
    c = load(spark, d, "conversations").select(F.col("conv_id").alias("work"), F.col("turn").alias("pre"), F.when(F.col("role") == "user", "chapter").when(F.col("role") == "assistant", "keyword").otherwise("other").alias("kind"), (F.col("turn") % 5 == 4).alias("no_toc"))
    return publish.file_names(c).select("work", "pre", "file")


@query("SELECT work, CAST(min(pre) AS BIGINT) AS pre, string_agg(t, ' ' ORDER BY pre) AS text FROM (SELECT *, sum(CASE WHEN selah THEN 0 ELSE 1 END) OVER (PARTITION BY work ORDER BY pre ROWS UNBOUNDED PRECEDING) AS line FROM (SELECT conv_id AS work, turn AS pre, turn % 3 = 2 AS selah, text AS t FROM conversations)) GROUP BY work, line")
def folded_lines(spark, d):  # RD11
    c = load(spark, d, "conversations").select(F.col("conv_id").alias("work"), F.col("turn").alias("pre"), F.when(F.col("turn") % 3 == 2, "selah").alias("type"), "text")
    return publish.fold_lines(c).select("work", "pre", "text")


@query("""
WITH n AS (SELECT l_orderkey AS k, l_linenumber AS pre, l_partkey AS p, CASE WHEN l_suppkey % 2 = 0 THEN l_linenumber END AS vs FROM (SELECT DISTINCT l_orderkey, l_linenumber, min(l_partkey) OVER w AS l_partkey, min(l_suppkey) OVER w AS l_suppkey FROM lineitem WINDOW w AS (PARTITION BY l_orderkey, l_linenumber))),
x AS (SELECT *, coalesce(vs, first_value(vs IGNORE NULLS) OVER (PARTITION BY k ORDER BY pre ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), last_value(vs IGNORE NULLS) OVER (PARTITION BY k ORDER BY pre ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS key FROM n)
SELECT k AS ch, CAST(key AS BIGINT) AS vs, string_agg(CAST(p AS VARCHAR), ' ' ORDER BY pre) AS text FROM x GROUP BY 1, 2""")
def verse_keyed_text(spark, d):  # RD22, SK5
    n = load(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("ch"), F.col("l_linenumber").alias("pre")).agg(F.min("l_partkey").cast("string").alias("text"), F.min("l_suppkey").alias("s"))
    n = n.select(F.lit("B").alias("book"), "ch", "pre", F.when(F.col("s") % 2 == 0, F.col("pre")).alias("vs"), "text")
    return publish.to_verses(n).select("ch", F.col("vs").cast("long").alias("vs"), "text")


@query("""
WITH i AS (SELECT s_suppkey // 10 AS work, s_suppkey AS id, s_suppkey * 3 AS lo, s_suppkey * 3 + s_nationkey AS hi FROM supplier), c AS (SELECT DISTINCT s_suppkey // 10 AS work, s_suppkey * 3 + 5 AS cut FROM supplier),
p AS (SELECT work, id, lo, hi FROM i UNION ALL SELECT i.work, id, cut, hi FROM i JOIN c ON c.work = i.work AND cut > lo AND cut <= hi)
SELECT id, row_number() OVER w AS part, lo, CAST(coalesce(lead(lo) OVER w - 1, hi) AS BIGINT) AS hi FROM p WINDOW w AS (PARTITION BY id ORDER BY lo)""")
def clipped_intervals(spark, d):  # TR6, TR3
    k = F.col("s_suppkey")
    iv = load(spark, d, "supplier").select(F.floor(k / 10).alias("work"), k.alias("id"), (k * 3).alias("lo"), (k * 3 + F.col("s_nationkey")).cast("long").alias("hi"))
    cuts = load(spark, d, "supplier").select(F.floor(k / 10).alias("work"), (k * 3 + 5).alias("at"))
    return publish.clip(iv, cuts).select("id", F.col("part").cast("long").alias("part"), "lo", "hi")


@query("SELECT a.s_suppkey AS a, d.s_suppkey AS d FROM (SELECT s_suppkey, s_nationkey AS b, s_suppkey AS pre, s_suppkey + 40 AS post FROM supplier WHERE s_suppkey % 2 = 0) a JOIN supplier d ON a.b % 3 = d.s_nationkey % 3 AND a.pre < d.s_suppkey AND d.s_suppkey <= a.post AND d.s_suppkey % 2 = 1")
def ancestor_pairs(spark, d):  # JN12, F1
    n = load(spark, d, "supplier").select(F.lit("w").alias("work"), (F.col("s_nationkey") % 3).alias("book"), F.col("s_suppkey").alias("pre"), (F.col("s_suppkey") + 40).alias("post"))
    return integrity.ancestors(n, F.col("pre") % 2 == 0, F.col("pre") % 2 == 1).select(F.col("a_pre").alias("a"), F.col("d_pre").alias("d"))


@query("SELECT n.s_suppkey FROM supplier n WHERE NOT EXISTS (SELECT 1 FROM supplier a WHERE a.s_nationkey % 5 = 0 AND a.s_suppkey // 10 = n.s_suppkey // 10 AND a.s_suppkey <= n.s_suppkey AND n.s_suppkey <= a.s_suppkey + a.s_nationkey % 4)")
def conversion_marks(spark, d):  # F5, F2
    n = load(spark, d, "supplier").select(F.floor(F.col("s_suppkey") / 10).alias("work"), F.col("s_suppkey").alias("pre"), (F.col("s_suppkey") + F.col("s_nationkey") % 4).alias("post"), F.when(F.col("s_nationkey") % 5 == 0, F.array(F.lit("module"))).otherwise(F.array().cast("array<string>")).alias("marks"))
    return integrity.conversion_filter(n, F.col("marks"), F.array().cast("array<string>"), ["epub"]).select(F.col("pre").alias("s_suppkey"))


# plans -------------------------------------------------------------------------------------------------------------


@query("WITH RECURSIVE x AS (SELECT s_suppkey AS job, (s_suppkey * 7 + 3) // 10 AS needs FROM supplier), c AS (SELECT * FROM x UNION SELECT c.job, x.needs FROM c JOIN x ON c.needs = x.job) SELECT job, needs FROM c")
def dep_closure(spark, d):  # AL1: chains that end in a job that needs itself
    k = F.col("s_suppkey")
    return graph.closure(load(spark, d, "supplier").select(k.alias("job"), F.floor((k * 7 + 3) / 10).alias("needs")))


@query("WITH RECURSIVE x AS (SELECT s_suppkey AS job, s_suppkey // 2 AS needs FROM supplier WHERE s_suppkey > 0), c AS (SELECT * FROM x UNION SELECT c.job, x.needs FROM c JOIN x ON c.needs = x.job) SELECT job, needs FROM c")
def ancestor_closure(spark, d):  # AL1, AL5 on a tree of suppliers
    return graph.closure(load(spark, d, "supplier").filter("s_suppkey > 0").select(F.col("s_suppkey").alias("job"), F.floor(F.col("s_suppkey") / 2).alias("needs")))


@query("WITH RECURSIVE x AS (SELECT s_suppkey AS job, s_suppkey // 3 AS needs FROM supplier WHERE s_suppkey > 0 UNION ALL SELECT s_suppkey, s_suppkey // 5 FROM supplier WHERE s_suppkey > 0 AND s_nationkey < 12), l(name, level) AS (SELECT DISTINCT needs, 0 FROM x WHERE needs NOT IN (SELECT job FROM x) UNION ALL SELECT x.job, l.level + 1 FROM l JOIN x ON x.needs = l.name) SELECT name, max(level) AS level FROM l GROUP BY name")
def job_levels(spark, d):  # AL2
    s, k = load(spark, d, "supplier").filter("s_suppkey > 0"), F.col("s_suppkey")
    deps = s.select(k.alias("job"), F.floor(k / 3).alias("needs")).unionByName(s.filter("s_nationkey < 12").select(k.alias("job"), F.floor(k / 5).alias("needs")))
    return graph.levels(deps).select("name", "level")


@query("""
WITH RECURSIVE e AS (SELECT s_suppkey AS job, s_suppkey // 3 AS needs FROM supplier WHERE s_suppkey > 0 UNION SELECT s_suppkey // 3, s_suppkey FROM supplier WHERE s_suppkey % 17 = 5),
c(a, b) AS (SELECT job, needs FROM e UNION SELECT c.a, e.needs FROM c JOIN e ON e.job = c.b),
r AS (SELECT DISTINCT a AS name FROM c WHERE a = b),
stuck AS (SELECT name FROM r UNION SELECT a FROM c WHERE b IN (SELECT name FROM r)),
ring AS (SELECT name FROM r UNION SELECT a FROM c WHERE b IN (SELECT name FROM r) AND a IN (SELECT b FROM c WHERE a IN (SELECT name FROM r))),
ok AS (SELECT job AS name FROM e UNION SELECT needs FROM e EXCEPT SELECT name FROM stuck),
l(name, level) AS (SELECT name, 0 FROM ok WHERE name NOT IN (SELECT job FROM e) UNION SELECT e.job, l.level + 1 FROM l JOIN e ON e.needs = l.name WHERE e.job IN (SELECT name FROM ok))
SELECT name, max(level) AS level, 'ready' AS state FROM l GROUP BY name UNION ALL SELECT name, NULL, CASE WHEN name IN (SELECT name FROM ring) THEN 'cycle' ELSE 'blocked' END FROM stuck""")
def stuck_jobs(spark, d):  # AL2
    s, k = load(spark, d, "supplier"), F.col("s_suppkey")
    up = s.filter(k > 0).select(k.alias("job"), F.floor(k / 3).alias("needs"))
    return graph.levels(up.unionByName(s.filter(k % 17 == 5).select(F.floor(k / 3).alias("job"), k.alias("needs"))))


@query("""
WITH RECURSIVE o AS (SELECT p_brand, p_partkey, CAST(p_size AS BIGINT) AS size, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS n FROM part),
r AS (SELECT p_brand, p_partkey, size, n, size + 1 AS run, 1 AS collection FROM o WHERE n = 1
 UNION ALL SELECT o.p_brand, o.p_partkey, o.size, o.n, CASE WHEN 11 + r.run + o.size > 300 THEN o.size + 1 ELSE r.run + o.size + 1 END, r.collection + CASE WHEN 11 + r.run + o.size > 300 THEN 1 ELSE 0 END FROM r JOIN o ON o.p_brand = r.p_brand AND o.n = r.n + 1)
SELECT p_brand, p_partkey, size, CAST(collection AS INTEGER) AS collection FROM r""")
def pack_collections(spark, d):  # AL4, SK8
    p = load(spark, d, "part").select("p_brand", "p_partkey", F.col("p_size").cast("long").alias("size"))
    return graph.bounded_collections(p, "p_brand", "p_partkey", "size", 300, 10, 1)


@query("SELECT p_partkey, CAST((row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1) // 25 AS BIGINT) AS batch FROM part")
def prompt_batches(spark, d):  # SK9
    return graph.batches(load(spark, d, "part"), ["p_brand"], ["p_partkey"], 25).select("p_partkey", "batch")


@query("SELECT p_partkey FROM part WHERE p_name LIKE '%bolt%' AND p_brand NOT LIKE 'Brand#1%' AND NOT (p_type = 'SMALL' AND p_size = 5)")
def jobs_to_run(spark, d):  # F22
    j = load(spark, d, "part").select("p_partkey", F.concat_ws(" ", "p_brand", "p_name").alias("module"), F.col("p_type").alias("script"), F.col("p_size").alias("kind"))
    return graph.jobs_to_run(j, "bolt", "^Brand#1", spark.createDataFrame([("SMALL", 5)], "script string, kind int")).select("p_partkey")


@query("SELECT d.doc_id, CAST(row_number() OVER (PARTITION BY d.doc_id ORDER BY pos) AS INTEGER) AS line_no, raw FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS pos, len(string_split(text, chr(10))) AS n FROM documents) d WHERE NOT (raw = '' AND pos = n)")
def source_lines(spark, d):  # SC1
    return commands.lines_of(load(spark, d, "documents"), "doc_id", "text")


@query("SELECT o_orderkey AS path, run, string_agg(r, ' ' ORDER BY rule) AS rules FROM (SELECT o_orderkey, run, rule, 's/' || rule || '/' || o_custkey || '/' AS r FROM orders, (VALUES (2, 1), (4, 1), (4, 3), (6, 3)) v(run, rule)) GROUP BY 1, 2")
def rules_in_force(spark, d):  # SC8: a rule on line 1 until line 5 cancels it, another from line 3
    rule = lambda n: F.concat(F.lit(f": s/{n}/"), F.col("o_custkey").cast("string"), F.lit("/"))
    text = F.concat(F.lit("EVAL_REGEX(a)"), rule(1), F.lit("\nRUN: one\nEVAL_REGEX(b)"), rule(3), F.lit("\nRUN: two\nEVAL_REGEX(a):\nRUN: three"))
    docs = load(spark, d, "orders").select(F.col("o_orderkey").alias("path"), text.alias("t"))
    r = commands.rules_in_force(commands.commands(commands.lines_of(docs, "path", "t"), "path"), "path")
    return r.groupBy("path", F.col("run_line").alias("run")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rule_line", "rule_value"))), lambda x: x["rule_value"]), " ").alias("rules"))


def _talks(spark, d):
    """Each conversation as a document of turns, shredded once for all steps."""
    graph.checkpoints(spark)
    esc = F.replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit("\r"), F.lit(""))
    turns = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", esc.alias("x")))), lambda r: F.concat(F.lit("<"), r["role"], F.lit(' n="'), r["turn"].cast("string"), F.lit('"><t>'), r["x"], F.lit("</t></"), r["role"], F.lit(">")))
    doc = load(spark, d, "conversations").groupBy("conv_id").agg(F.concat(F.lit("<d>"), F.array_join(turns, ""), F.lit("</d>")).alias("xml"))
    return xml.shred(doc, "conv_id", "xml").checkpoint()


@query("SELECT c.conv_id, c.turn FROM conversations c JOIN (SELECT conv_id, min(turn) AS first FROM conversations WHERE role = 'assistant' GROUP BY 1) a ON c.conv_id = a.conv_id WHERE c.role = 'user' AND c.turn > first AND c.text <> '' AND c.turn % 4 <> 0")
def path_selection(spark, d):  # F1, RG8: user turns behind an assistant's, but for every fourth, by their texts
    n = _talks(spark, d)
    users = paths.step(n, paths.step(n, paths.roots(n), "child", "assistant"), "following-sibling", "user")
    wanted = paths.lacking(users, paths.step(n, users, "self", where=F.col("attrs")["n"].cast("int") % 4 == 0))
    said = paths.step(n, paths.step(n, wanted, "descendant", "t"), "child", where=F.col("kind") == "text")
    back = paths.nearest(n, said, "ancestor", "user").select("work", F.col("found").alias("pre")).distinct()
    return paths.step(n, back, "self").select(F.col("work").cast("long").alias("conv_id"), F.col("attrs")["n"].cast("long").alias("turn"))


@query("SELECT conv_id, turn, 'd/' || role || '/t' AS chain FROM conversations WHERE text <> ''")
def ancestor_chains(spark, d):  # AL5, F1
    n = _talks(spark, d)
    said = paths.chains(n, n.filter("kind = 'text'")).select("work", "pre", F.array_join("chain", "/").alias("chain"))
    turn = paths.nearest(n, said, "ancestor", where=F.col("depth") == 1).join(said, ["work", "pre"])
    return turn.join(n.select("work", F.col("pre").alias("found"), "attrs"), ["work", "found"]).select(F.col("work").cast("long").alias("conv_id"), F.col("attrs")["n"].cast("long").alias("turn"), "chain")


@query("SELECT conv_id, turn FROM (SELECT *, min(CASE WHEN role = 'assistant' THEN turn END) OVER (PARTITION BY conv_id) AS first FROM conversations) WHERE role = 'system' AND turn < first")
def intro_hazards(spark, d):  # DQ5: system turns as section titles, the assistant's as chapters
    return order.intro_hazards(load(spark, d, "conversations"), F.col("role") == "system", F.col("role") == "assistant", ["conv_id"], "turn").select("conv_id", "turn")


@query("SELECT conv_id, count(*) AS n FROM conversations WHERE role IN ('user', 'assistant') AND turn <> 2 AND regexp_matches(text, '[^\\s]') GROUP BY conv_id")
def searched_texts(spark, d):  # F2
    n = _talks(spark, d)
    only = n.filter("kind = 'element' AND name IN ('user', 'assistant')")
    return paths.texts_to_search(n, only, n.filter((F.col("kind") == "element") & (F.col("attrs")["n"] == "2")), "system").groupBy(F.col("work").cast("long").alias("conv_id")).agg(F.count("*").alias("n"))


@query("""
WITH k AS (SELECT p_name AS w FROM part WHERE p_size > 25), r AS (SELECT CASE p_partkey % 4 WHEN 0 THEN ' ' WHEN 1 THEN 'D:' || p_name WHEN 2 THEN 'D:none' || p_size ELSE 'X:' || p_size END AS t FROM part)
SELECT 'duplicate keyword' AS finding, w AS what, count(*) AS n FROM k GROUP BY w HAVING count(*) > 1
UNION ALL SELECT 'empty target', '', count(*) FROM r WHERE trim(t) = '' HAVING count(*) > 0
UNION ALL SELECT 'missing target', replace(t, ' ', '_32_'), count(*) FROM r WHERE starts_with(t, 'D:') AND substr(t, 3) NOT IN (SELECT w FROM k) GROUP BY t
UNION ALL SELECT 'missing file', s_name, 1 FROM supplier WHERE s_nationkey % 2 = 1""")
def module_findings(spark, d):  # JN18
    p, m, s = load(spark, d, "part"), F.col("p_partkey") % 4, load(spark, d, "supplier")
    ref = F.when(m == 0, " ").when(m == 1, F.concat(F.lit("D:"), F.replace("p_name", F.lit(" "), F.lit("_32_")))).when(m == 2, F.concat(F.lit("D:none"), F.col("p_size").cast("string"))).otherwise(F.concat(F.lit("X:"), F.col("p_size").cast("string")))
    return paths.module_findings(p.filter("p_size > 25").select(F.col("p_name").alias("keyword")), p.select(ref.alias("ref")), s.select(F.col("s_name").alias("src")), s.filter("s_nationkey % 2 = 0").select(F.col("s_name").alias("path")), "D")


@query("""
WITH v AS (SELECT s_nationkey AS k, s_suppkey // 12 AS b FROM supplier), u AS (SELECT DISTINCT k, b FROM v),
m AS (SELECT max(s_suppkey) // 12 AS last FROM supplier), r AS (SELECT k, min(b) AS lo, max(b) AS hi FROM (SELECT k, b, b - row_number() OVER (PARTITION BY k ORDER BY b) AS g FROM u) GROUP BY k, g)
SELECT k, string_agg(CASE WHEN lo = hi THEN 'B' || lo ELSE 'B' || lo || '-B' || hi END, ' ' ORDER BY lo) AS scope FROM r GROUP BY k""")
def book_scopes(spark, d):  # RG5: suppliers of a nation as books of 2 chapters of 3 verses
    s = load(spark, d, "supplier")
    b = F.floor(F.col("s_suppkey") / 12)
    name = F.concat(F.lit("B"), b.cast("string"))
    chapters = s.select(F.lit("S").alias("vsys"), name.alias("book"), b.alias("book_ord"), F.lit("OT").alias("testament"), F.explode(F.array(F.lit(1), F.lit(2))).alias("ch"), F.lit(3).alias("last_vs")).distinct()
    return ranges.books_scope(s.select(F.col("s_nationkey").alias("k"), name.alias("book")), ranges.verse_index(chapters), ["k"], "S")


@query("SELECT conv_id, turn, role AS name, text FROM conversations")
def shredded_nodes(spark, d):  # SC5, D2: each conversation as a document of turns, shredded again
    esc = F.replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit("\r"), F.lit(""))
    doc = load(spark, d, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", esc.alias("x")))), lambda r: F.concat(F.lit("<"), r["role"], F.lit(' n="'), r["turn"].cast("string"), F.lit('">'), r["x"], F.lit("</"), r["role"], F.lit(">"))), "").alias("b"))
    n = xml.shred(doc.select("conv_id", F.concat(F.lit("<d>"), "b", F.lit("</d>")).alias("xml")), "conv_id", "xml")
    e, t = n.filter("kind = 'element' AND depth = 1"), n.filter("kind = 'text'").select("work", F.col("parent").alias("pre"), F.col("text").alias("said"))
    return e.join(t, ["work", "pre"]).select(F.col("work").cast("long").alias("conv_id"), F.col("attrs")["n"].cast("long").alias("turn"), "name", F.col("said").alias("text"))


@query("SELECT c_custkey AS key, coalesce(CASE WHEN c_acctbal > 0 THEN c_name END, c_mktsegment) AS value FROM customer")
def settings_with_defaults(spark, d):  # SC14
    c = load(spark, d, "customer")
    return conf.with_defaults(c.filter("c_acctbal > 0").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("value")), c.select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("value")))


@query("SELECT p_name AS name, arg_min(p_partkey, p_retailprice) AS path FROM part GROUP BY p_name")
def default_files(spark, d):  # SC18, SC20
    p = load(spark, d, "part").select(F.col("p_name").alias("name"), F.col("p_partkey").alias("path"), F.col("p_retailprice").alias("priority"))
    return conf.default_file(p)


# quality -----------------------------------------------------------------------------------------------------------


@query("""
SELECT check_, location, message FROM (
SELECT 'missing target' AS check_, CAST(o_orderkey AS VARCHAR) AS location, CAST(o_custkey AS VARCHAR) AS message FROM orders WHERE o_orderstatus <> 'F' AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0 UNION ALL SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)
UNION ALL SELECT 'outside verse system', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'F' AND o_custkey NOT IN (SELECT s_suppkey FROM supplier)
UNION ALL SELECT 'repeated id', CAST(id AS VARCHAR), CAST(count(*) AS VARCHAR) FROM (SELECT c_custkey AS id FROM customer WHERE c_acctbal > 0 UNION ALL SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY id HAVING count(*) > 1)""")
def integrity_suite(spark, d):  # DQ2
    refs = load(spark, d, "orders").select(F.col("o_orderkey").alias("location"), F.col("o_custkey").alias("target"), (F.col("o_orderstatus") == "F").alias("is_verse"))
    ids = load(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("id")).unionByName(load(spark, d, "supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("id")))
    return quality.integrity_suite(refs, ids, load(spark, d, "supplier").select(F.col("s_suppkey").alias("id"))).select(F.col("check").alias("check_"), "location", "message")


@query("SELECT o_orderkey, o_custkey IN (SELECT s_suppkey FROM supplier) AS in_system FROM orders")
def verse_system_ids(spark, d):  # SF17
    return quality.in_verse_system(load(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_custkey", load(spark, d, "supplier").select(F.col("s_suppkey").alias("id"))).select("o_orderkey", "in_system")


@query("SELECT l_orderkey, CASE WHEN a <> 'skip' THEN a END AS last_book, CASE WHEN b <> 'skip' THEN b END AS first_book FROM (SELECT l_orderkey, max_by(v, r) AS a, min_by(v, r) AS b FROM (SELECT l_orderkey, lpad(CAST(l_linenumber * 100000 + l_partkey AS VARCHAR), 9, '0') || l_suppkey AS r, CASE WHEN l_returnflag = 'R' THEN 'skip' ELSE l_returnflag END AS v FROM lineitem) GROUP BY 1)")
def rule_overrides(spark, d):  # F3, F4
    m = load(spark, d, "lineitem").select("l_orderkey", F.concat(F.lpad((F.col("l_linenumber") * 100000 + F.col("l_partkey")).cast("string"), 9, "0"), F.col("l_suppkey").cast("string")).alias("r"), F.when(F.col("l_returnflag") == "R", "skip").otherwise(F.col("l_returnflag")).alias("v"))
    last, first = quality.override(m, "l_orderkey", "r", "v", True), quality.override(m, "l_orderkey", "r", "v", False)
    return last.withColumnRenamed("v", "last_book").join(first.withColumnRenamed("v", "first_book"), "l_orderkey")


@query("SELECT event_id, CASE WHEN event_type = 'click' THEN coalesce(CASE WHEN value < 5 THEN -1 END, last_value(CASE WHEN event_type = 'view' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) END AS target FROM events")
def note_targets(spark, d):  # AN15
    e = load(spark, d, "events").select(F.lit("w").alias("work"), F.col("user_id").alias("book"), F.col("event_id").alias("pre"), F.when(F.col("event_type") == "view", "verse").when(F.col("event_type") == "click", "note").otherwise("x").alias("name"), F.col("event_id").alias("id"), F.when(F.col("value") < 5, -1).cast("long").alias("annotate_ref"))
    return quality.note_targets(e).select(F.col("pre").alias("event_id"), "target")


@query("SELECT doc_id, regexp_extract(text, '([$][$]+|[#][#]+)', 1) AS first, CAST(len(regexp_extract_all(text, '[$][$]+|[#][#]+')) AS BIGINT) AS n FROM documents WHERE regexp_matches(text, '[$][$]+|[#][#]+')")
def leftover_markup(spark, d):  # DQ10
    return quality.leftover_markup(load(spark, d, "documents"), "doc_id", "text", "[$][$]+|[#][#]+")


@query("SELECT doc_id FROM documents WHERE contains(text, 'ei')")
def changed_texts(spark, d):  # DQ11: adding markup changes nothing, replacing letters does
    docs = load(spark, d, "documents").select("doc_id", "text")
    after = docs.withColumn("text", F.concat(F.lit("<p>"), F.replace("text", F.lit("ei"), F.lit("EI")), F.lit("</p>")))
    return quality.changed_texts(docs, after, "doc_id", "text")


@query("SELECT CAST(doc_id AS VARCHAR) AS location FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def dropped_material(spark, d):  # DQ13
    return quality.dropped_material(load(spark, d, "documents").select("doc_id"), load(spark, d, "labels"), "doc_id").select("location")


@query("SELECT l_orderkey, l_linenumber, l_partkey AS target FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'ECONOMY' AND p_size < 5)")
def misused_aggregates(spark, d):  # JN19
    refs = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("target"))
    return quality.misused_aggregates(refs, load(spark, d, "part").filter("p_type = 'ECONOMY' AND p_size < 5").select(F.col("p_partkey").alias("id"))).select("l_orderkey", "l_linenumber", "target")


@query("SELECT conv_id AS work, turn AS pre, CASE WHEN conv_id % 2 = 0 THEN turn = min(turn) OVER w ELSE turn = max(turn) OVER w END AS holds_toc FROM conversations WINDOW w AS (PARTITION BY conv_id, role)")
def toc_places(spark, d):  # RD4
    c = load(spark, d, "conversations").select(F.col("conv_id").alias("work"), F.col("role").alias("parent"), F.col("turn").alias("pre"), F.when(F.col("conv_id") % 2 == 0, "first").otherwise("last").alias("place"))
    return quality.toc_places(c).select("work", "pre", "holds_toc")


@query("SELECT p_partkey, p_brand || '-' || p_size || '.html' AS file, regexp_replace(p_name, '(?i)BOLT', 'nut', 'g') AS name FROM part")
def file_names(spark, d):  # UX2, UX5
    return load(spark, d, "part").select("p_partkey", quality.file_name("{p_brand}-{p_size}.html").alias("file"), quality.rewrite(F.col("p_name"), [("BOLT", "nut", "i")]).alias("name"))


@query("SELECT s_suppkey, s_name, n FROM supplier, (SELECT count(*) AS n FROM nation)")
def fanned_out_calls(spark, d):  # JN20: one row of constants
    return quality.calls(load(spark, d, "nation").agg(F.count("*").alias("n")), load(spark, d, "supplier").select("s_suppkey", "s_name"))


@query("SELECT o_orderkey AS path FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def used_files(spark, d):  # SK12
    return quality.used_files(load(spark, d, "orders").select(F.col("o_orderkey").alias("path")), load(spark, d, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("src")))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'own' ELSE 'main' END AS value FROM customer")
def header_settings(spark, d):  # SC23
    c = load(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("work"))
    rows = c.select("work", F.lit("Title").alias("key"), F.lit("main").alias("value")).unionByName(c.filter("work % 3 = 0").select("work", F.concat("work", F.lit("+Title")).alias("key"), F.lit("own").alias("value")))
    return quality.header_conf(rows).select(F.col("work").cast("long").alias("c_custkey"), "value")


@query("SELECT user_id, CAST(count(*) AS BIGINT) AS n_sessions FROM (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS b FROM events) WHERE b IS NULL OR ts - b >= INTERVAL 30 MINUTE GROUP BY user_id")
def event_sessions(spark, d):  # an extension: sessions by time
    from quire.streaming.sessions import session_counts

    return session_counts(load(spark, d, "events"), "user_id", "ts").groupBy("user_id").agg(F.count("*").alias("n_sessions"))
