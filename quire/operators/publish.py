"""Publications: scope filters, sections, tables of contents, menus, and node rendering, on node tables.

A node is (work, book, pre, post, parent, depth, kind, name, type, text, attrs); pre is document order, and a node's
descendants are those with pre in (its pre, its post].
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.operators.order import islands, neighbours, sessions


def by_scope(nodes: DataFrame, publications: DataFrame) -> DataFrame:
    """all publications at once: nodes of the books in a publication's scope. publications: (pub_id, books array).

    Nodes outside books stay in every publication; `is_first_book` marks the nodes of the first book left, for what is relocated there."""
    books = publications.select("pub_id", F.explode("books").alias("book"))
    kept = nodes.filter("book IS NOT NULL").join(books, "book")
    loose = nodes.filter("book IS NULL").crossJoin(publications.select("pub_id"))
    every = kept.unionByName(loose)
    first = F.min_by("book", F.when(F.col("book").isNotNull(), F.col("pre"))).over(Window.partitionBy("pub_id", "work"))
    return every.withColumn("is_first_book", F.col("book").eqNullSafe(first) & F.col("book").isNotNull())


def glossary_by_scope(divs: DataFrame, scope: DataFrame) -> DataFrame:
    """F8: glossary divisions (div, scopes array) that share a book with the scope, or have no scope; with the summary
    outcome: all, none or some."""
    want = scope.agg(F.collect_set("book").alias("__want"))
    marked = divs.crossJoin(F.broadcast(want)).withColumn("is_kept", (F.size("scopes") == 0) | F.arrays_overlap("scopes", "__want")).drop("__want")
    total = marked.agg(F.bool_and("is_kept").alias("__all"), F.bool_or("is_kept").alias("__any"))
    return marked.crossJoin(F.broadcast(total)).withColumn("outcome", F.when(F.col("__all"), "all").when(F.col("__any"), "some").otherwise("none")).drop("__all", "__any")


def subentries_by_scope(subs: DataFrame, scope: DataFrame) -> DataFrame:
    """aggregate subentries (entry, sub, scope, title) in scope; the title goes if just one is left."""
    left = subs.filter("scope IS NULL").unionByName(subs.filter("scope IS NOT NULL").join(scope.select(F.col("book").alias("scope")).distinct(), "scope", "left_semi").select(subs.columns))
    n = F.count("*").over(Window.partitionBy("entry"))
    return left.withColumn("title", F.when(n == 1, None).otherwise(F.col("title")))


def removals(nodes: DataFrame, target: str) -> DataFrame:
    """nodes that a target never has: navigation menus for print, duplicates or aggregates, empty titles, images for text."""
    empty_title = (F.col("name") == "title") & (F.trim(F.coalesce("text", F.lit(""))) == "")
    drop = {"module": (F.col("type") == "x-navmenu") | (F.col("type") == "x-aggregate"), "ebook": F.col("type") == "x-duplicate", "text": F.col("name") == "figure"}[target]
    return nodes.filter(~(F.coalesce(drop, F.lit(False)) | F.coalesce(empty_title, F.lit(False))))


def without_references(nodes: DataFrame, targets: DataFrame) -> DataFrame:
    """references (name reference, ref) whose target is missing become plain text; note references become bold."""
    have = targets.select(F.col("id").alias("__t")).distinct()
    out = nodes.join(have, F.col("ref") == F.col("__t"), "left")
    lost = (F.col("name") == "reference") & F.col("__t").isNull()
    return out.withColumn("name", F.when(lost & (F.col("type") == "annotateRef"), "hi").when(lost, F.lit(None)).otherwise(F.col("name"))).drop("__t")


def without_prefix(df: DataFrame, refs: str, work: str) -> DataFrame:
    """the default work's prefix removed from every id of a list, and how many were removed."""
    p = f"(^|\\s){work}:"
    return df.withColumn("n_removed", F.regexp_count(refs, F.lit(p))).withColumn(refs, F.regexp_replace(refs, p, "$1"))


def sections(nodes: DataFrame, starts: Column) -> DataFrame:
    """SK3/RD3/TR5: nodes by the table-of-contents marker that they follow (section 0: before the first)."""
    return sessions(nodes, starts, ["work"], ["pre"], "section")


def toc_levels(nodes: DataFrame, cap: int = 3) -> DataFrame:
    """WN12: a toc row's level: `[levelN]` in its text, or one more than the markers above it; at most cap.

    Levels above come from interval containment, so no recursion is needed."""
    toc = nodes.filter("is_toc")
    a = toc.select("work", F.col("pre").alias("a_pre"), F.col("post").alias("a_post"))
    above = toc.join(a, "work").filter("a_pre < pre AND pre <= a_post").groupBy("work", "pre").agg(F.count("*").alias("above"))
    said = F.expr("try_cast(nullif(regexp_extract(text, '\\\\[level(\\\\d)\\\\]', 1), '') AS int)")
    return toc.join(above, ["work", "pre"], "left").withColumn("level", F.least(F.coalesce(said, F.coalesce("above", F.lit(0)) + 1), F.lit(cap)).cast("int")).drop("above")


def toc_roles(toc: DataFrame) -> DataFrame:
    """WN14/AN16: the role of each toc row by where it stands: book (first of its book), book intro (before the first chapter), whole
    intro (before any book), glossary, other. toc: work, pre, book, testament, first_chapter, in_glossary."""
    first = F.row_number().over(Window.partitionBy("work", "book").orderBy("pre")) == 1
    start = F.min(F.when(F.col("book").isNotNull(), F.col("pre"))).over(Window.partitionBy("work"))
    role = F.when(F.col("in_glossary"), "glossary").when(F.col("book").isNotNull() & first, "book").when(F.col("book").isNotNull() & (F.col("pre") < F.col("first_chapter")), "book intro").when(F.col("book").isNull() & (F.col("pre") < start), "whole intro").otherwise("other")
    return toc.withColumn("role", role)


def toc_names(books: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """AN16: a book's name from the first candidate column that has one."""
    return books.withColumn("toc_name", F.coalesce(*(F.nullif(F.trim(c), F.lit("")) for c in candidates)))


def inline_toc(toc: DataFrame, reduce_to_letter: bool = False) -> DataFrame:
    """AN18: for each toc row the rows one level below it before the next row of its level or above, their titles joined."""
    up = toc.select("work", F.col("pre").alias("p"), F.col("level").alias("l"))
    w = Window.partitionBy("work", "p").orderBy("q")
    ends = up.join(toc.select("work", F.col("pre").alias("q"), F.col("level").alias("m")), "work").filter("q > p AND m <= l").groupBy("work", "p").agg(F.min("q").alias("until"))
    spans = up.join(ends, ["work", "p"], "left")
    kids = spans.join(toc.select("work", F.col("pre").alias("q"), F.col("level").alias("m"), "title"), "work").filter("q > p AND m = l + 1 AND (until IS NULL OR q < until)")
    if reduce_to_letter:
        kids = kids.withColumn("title", F.upper(F.substring("title", 1, 1))).withColumn("__new", ~F.lag("title").over(w).eqNullSafe(F.col("title"))).filter("__new").drop("__new")
    return kids.groupBy("work", F.col("p").alias("pre")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("q", "title"))), lambda x: x["title"]), " | ").alias("items"))


def menus(keywords: DataFrame, by: Sequence[str], order: Sequence[str], title: str) -> DataFrame:
    """AN17: for each keyword the links of its menu: prev, next, and whether it opens a letter of the A-Z menu."""
    out = neighbours(keywords, title, by, order)
    letter = F.upper(F.substring(title, 1, 1))
    return out.withColumn("letter", letter).withColumn("opens_letter", ~F.lag(letter).over(Window.partitionBy(*by).orderBy(*order)).eqNullSafe(letter))


def sub_publications(files: DataFrame, path: str, books: DataFrame) -> DataFrame:
    """SC20: publications by the directories that hold files: (dir, name, place). A number before the name gives the place, else the
    first book of its files in canon order. books: (code, ord); a file's code is its first three letters."""
    code = F.upper(F.substring(F.substring_index(path, "/", -1), 1, 3))
    found = files.select(F.regexp_extract(path, "([^/]+)/[^/]*$", 1).alias("dir"), code.alias("code")).join(books, "code", "left")
    prefix = F.expr("try_cast(nullif(regexp_extract(dir, '^([0-9]+)[ ._-]', 1), '') AS int)")
    one = found.groupBy("dir").agg(F.min("ord").alias("ord"))
    return one.select("dir", F.regexp_replace("dir", "^[0-9]+[ ._-]", "").alias("name"), F.coalesce(prefix, "ord").alias("place"))


def canon_dump(canon: DataFrame) -> DataFrame:
    """SK10: a verse system as XML, a row for each book. canon: vsys, book, book_ord, ch, last_vs."""
    chapter = F.concat(F.lit('<chapter n="'), F.col("ch").cast("string"), F.lit('" verses="'), F.col("last_vs").cast("string"), F.lit('"/>'))
    body = canon.groupBy("vsys", "book", "book_ord").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ch", chapter.alias("x")))), lambda s: s["x"]), "").alias("x"))
    return body.select("vsys", "book_ord", F.concat(F.lit('<book id="'), "book", F.lit('">'), "x", F.lit("</book>")).alias("xml"))


def custom_menus(menus_: DataFrame, custom: DataFrame) -> DataFrame:
    """RD21: a custom menu replaces the made one, or stands on top of it (place `top`)."""
    return menus_.join(custom.withColumnRenamed("body", "__b"), "id", "left").withColumn("body", F.when(F.col("__b").isNull(), F.col("body")).when(F.col("place") == "top", F.concat("__b", "body")).otherwise(F.col("__b"))).drop("__b", "place")


def containers(marks: DataFrame, nodes: DataFrame) -> DataFrame:
    """TR2/D3: milestone pairs (work, id, pre_start, pre_end) as containers: each node with the ids that are open there, innermost last."""
    hit = nodes.join(marks, "work").filter("pre > pre_start AND pre < pre_end")
    ids = hit.groupBy("work", "pre").agg(F.transform(F.array_sort(F.collect_list(F.struct("pre_start", "id"))), lambda x: x["id"]).alias("inside"))
    return nodes.join(ids, ["work", "pre"], "left")


def clip(intervals: DataFrame, cuts: DataFrame) -> DataFrame:
    """TR6/TR3: intervals (work, id, lo, hi) cut wherever a cut (work, at) lies inside, so that none crosses a verse: pieces
    (id, part from 1, lo, hi)."""
    inner = intervals.join(cuts, "work").filter("at > lo AND at <= hi").groupBy("work", "id", "lo", "hi").agg(F.array_sort(F.collect_set("at")).alias("ats"))
    every = intervals.join(inner, ["work", "id", "lo", "hi"], "left")
    starts = F.concat(F.array("lo"), F.coalesce("ats", F.array().cast(f"array<{intervals.schema['lo'].dataType.simpleString()}>")))
    rows = every.withColumn("s", starts).select("work", "id", "hi", "s", F.posexplode("s").alias("k", "a"))
    return rows.select("work", "id", (F.col("k") + 1).alias("part"), F.col("a").alias("lo"), F.coalesce(F.get("s", F.col("k") + 1) - 1, F.col("hi")).alias("hi"))


def split_books(nodes: DataFrame) -> DataFrame:
    """TR1: the partition key of each node, for writing with partitionBy: its book or `other`."""
    return nodes.withColumn("part", F.coalesce("book", F.lit("other")))


def place(nodes: DataFrame, directives: DataFrame) -> DataFrame:
    """TR4: remove, move or copy subtrees before targets. directives: (work, action, pre_lo, pre_hi, before). The new order is a
    key (major, minor, pre), so nothing is renumbered; a copy goes before every target of its directive and shares a hash."""
    hit = nodes.join(directives, "work").filter("pre BETWEEN pre_lo AND pre_hi")
    gone = hit.filter("action IN ('remove', 'move')").select("work", "pre").distinct()
    stays = nodes.join(gone, ["work", "pre"], "left_anti").withColumn("major", F.col("pre").cast("long")).withColumn("minor", F.lit(1)).withColumn("copy_of", F.lit(None).cast("string"))
    put = hit.filter("action IN ('copy', 'move')").withColumn("major", F.col("before").cast("long")).withColumn("minor", F.lit(0))
    put = put.withColumn("copy_of", F.when(F.col("action") == "copy", F.substring(F.md5(F.concat_ws(":", "work", F.col("pre_lo").cast("string"), F.col("pre_hi").cast("string"))), 1, 4)))
    return stays.unionByName(put.select(stays.columns)).withColumn("new_pre", F.row_number().over(Window.partitionBy("work").orderBy("major", "minor", "pre")) - 1)


def combined_glossary(entries: DataFrame, sort: Column) -> DataFrame:
    """TR8/ST5: duplicates dropped, aggregates kept, in the collation's order, each with its letter heading."""
    kept = entries.filter("type IS NULL OR type <> 'x-duplicate'")
    w = Window.partitionBy("work").orderBy(sort, "pre")
    letter = F.upper(F.substring("title", 1, 1))
    return kept.withColumn("place", F.row_number().over(w)).withColumn("heading", F.when(F.lag(letter).over(w).eqNullSafe(letter), None).otherwise(letter))


#: What a node's start becomes, by target.
HTML = {"p": "p", "head": "h2", "list": "ul", "item": "li", "table": "table", "row": "tr", "cell": "td", "lb": "br", "figure": "img", "l": "div", "lg": "div", "hi": "span", "seg": "span", "foreign": "span", "catchWord": "span", "transChange": "span", "rdg": "span", "signed": "span", "k": "dfn", "reference": "a", "note": "sup"}
FB2 = {"p": "p", "head": "subtitle", "list": "table", "item": "tr", "table": "table", "row": "tr", "cell": "td", "lb": "empty-line", "figure": "image", "l": "v", "lg": "stanza", "hi": "emphasis", "seg": "style", "foreign": "style", "catchWord": "emphasis", "transChange": "emphasis", "rdg": "style", "signed": "text-author", "k": "strong", "reference": "a", "note": "a"}
DROPPED = ("header", "index", "milestone")
UNWRAPPED = ("osis", "osisText", "name")


def output_tag(target: str, name: Column, type_: Column, level: Column) -> Column:
    """RD1/RD2/RD8-RD12: the element that a node becomes, null if only its text (or an anchor) stays."""
    table = HTML if target == "html" else FB2
    known = F.create_map(*(F.lit(x) for kv in table.items() for x in kv))
    dropped = name.isin(*DROPPED, *UNWRAPPED) | ((name == "title") & (type_ == "runningHead"))
    title = F.when(type_ == "parallel", F.lit("h2")).otherwise(F.concat(F.lit("h"), F.coalesce(level, F.lit(1)).cast("string"))) if target == "html" else F.lit("subtitle")
    return F.when(dropped, None).when(name == "title", title).otherwise(F.coalesce(F.element_at(known, name), name))


def verse_labels(verses: DataFrame) -> DataFrame:
    """RD6: `first-last` of a verse's ids, and one anchor for each id. verses: work, pre, ids (array of BOOK.CH.VS)."""
    number = lambda x: F.substring_index(x, ".", -1)
    label = F.when(F.size("ids") > 1, F.concat_ws("-", number(F.element_at("ids", 1)), number(F.element_at("ids", -1)))).otherwise(number(F.element_at("ids", 1)))
    return verses.withColumn("label", label).withColumn("anchors", F.array_join(F.transform("ids", lambda x: F.concat(F.lit('<a id="'), x, F.lit('"/>'))), ""))


def chapter_numbers(blocks: DataFrame) -> DataFrame:
    """RD7: the chapter number stands in the chapter's first block."""
    return blocks.withColumn("shows_chapter", F.row_number().over(Window.partitionBy("work", "book", "ch").orderBy("pre")) == 1)


def fold_lines(lines: DataFrame) -> DataFrame:
    """RD11: runs of lines of type selah join the line before them."""
    keyed = sessions(lines, F.coalesce(F.col("type") != "selah", F.lit(True)), ["work"], ["pre"], "line")
    return keyed.groupBy("work", "line").agg(F.min("pre").alias("pre"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pre", "text"))), lambda x: x["text"]), " ").alias("text"))


def note_bodies(notes: DataFrame) -> DataFrame:
    """RD13/WN4: numbered markers, and the bodies of each file and kind (footnote, crossReference) in order."""
    n = notes.withColumn("number", F.row_number().over(Window.partitionBy("file", "kind").orderBy("pre")))
    return n.groupBy("file", "kind").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pre", "number", "text"))), lambda x: F.concat(x["number"].cast("string"), F.lit(" "), x["text"])), "\n").alias("body"))


def note_heads(notes: DataFrame) -> DataFrame:
    """RD18: a note's heading is merged into its body, ` - ` between them if the body begins with a letter or digit."""
    return notes.withColumn("text", F.when(F.col("heading").isNull(), F.col("text")).when(F.col("text").rlike("^[\\p{L}\\p{N}]"), F.concat_ws(" - ", "heading", "text")).otherwise(F.concat("heading", "text")))


def link_targets(refs: DataFrame, ids: DataFrame, redirect: str | None = None) -> DataFrame:
    """RD15/RD19: references (ref) to hrefs: a book means its first verse, a chapter likewise; several or no targets are findings, and with
    redirect a missing one goes there."""
    full = F.when(F.col("ref").rlike("^[^.]+$"), F.concat("ref", F.lit(".1.1"))).when(F.col("ref").rlike("^[^.]+\\.\\d+$"), F.concat("ref", F.lit(".1"))).otherwise(F.col("ref"))
    n = ids.groupBy("id").agg(F.min("file").alias("file"), F.count("*").alias("n"))
    out = refs.withColumn("target", full).join(n, F.col("target") == F.col("id"), "left").drop("id")
    href = F.when(F.col("n") == 1, F.concat_ws("#", "file", "target"))
    if redirect:
        href = F.coalesce(href, F.when(F.col("n").isNull(), F.concat(F.lit(redirect), F.col("target"))))
    return out.withColumn("href", href).withColumn("finding", F.when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "several"))


def file_names(secs: DataFrame) -> DataFrame:
    """RD20: `ch_1`, `kw_2`, ... numbered by kind within their work in order; sections out of the contents (no_toc) have none."""
    kind = F.when(F.col("kind") == "chapter", "ch").when(F.col("kind") == "keyword", "kw").when(F.col("kind") == "milestone", "ms").otherwise("ot")
    named = secs.withColumn("__k", kind)
    n = F.row_number().over(Window.partitionBy("work", "__k", "no_toc").orderBy("pre"))
    return named.withColumn("file", F.when(~F.col("no_toc"), F.concat_ws("_", "__k", n.cast("string")))).drop("__k")


def loose_runs(nodes: DataFrame, is_block: Column) -> DataFrame:
    """RD17/RD14: numbers runs of loose nodes between blocks, which are wrapped in a paragraph each."""
    return islands(nodes.withColumn("is_block", is_block), "is_block", ["work"], ["pre"], "run")


def without_repeated_heads(nodes: DataFrame) -> DataFrame:
    """RD16: drops a heading that repeats the title before it."""
    w = Window.partitionBy("work").orderBy("pre")
    rep = (F.col("name") == "head") & (F.lag("name").over(w) == "title") & (F.lag("text").over(w) == F.col("text"))
    return nodes.withColumn("__r", F.coalesce(rep, F.lit(False))).filter("NOT __r").drop("__r")


def to_verses(nodes: DataFrame) -> DataFrame:
    """RD22/SK5: text outside verses goes to the next verse of its chapter, or else to the last one: verse-keyed text.
    nodes: book, ch, pre, vs (null outside), text."""
    w = Window.partitionBy("book", "ch").orderBy("pre")
    nxt = F.first("vs", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    prev = F.last("vs", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    keyed = nodes.withColumn("key_vs", F.coalesce("vs", nxt, prev, F.lit(0)))
    return keyed.groupBy("book", "ch", F.col("key_vs").alias("vs")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pre", "text"))), lambda x: x["text"]), " ").alias("text"))


def tree_paths(nodes: DataFrame, ident: str) -> DataFrame:
    """SK6: the tree key of each node with an id: the ids of its ancestors and its own, joined by slashes."""
    keyed = nodes.filter(F.col(ident).isNotNull())
    a = keyed.select("work", F.col("pre").alias("a_pre"), F.col("post").alias("a_post"), F.col(ident).alias("a_id"))
    hit = keyed.join(a, "work").filter("a_pre <= pre AND pre <= a_post")
    return hit.groupBy("work", "pre", ident).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("a_pre", "a_id"))), lambda x: x["a_id"]), "/").alias("path"))


def clean_markup(s: Column) -> Column:
    """RD23: comments dropped, the named entities that XML does not know replaced, white space squeezed."""
    out = F.regexp_replace(s, "(?s)<!--.*?-->", "")
    for name, char in (("nbsp", " "), ("mdash", "—"), ("ndash", "–"), ("hellip", "…")):
        out = F.replace(out, F.lit(f"&{name};"), F.lit(char))
    return F.trim(F.regexp_replace(out, "[ \\t\\r\\n]+", " "))


def copyright_lines(conf: DataFrame, entries: Sequence[str]) -> DataFrame:
    """AN20/AN21: a work's statement from its entries in a fixed order, missing ones left out."""
    wide = conf.groupBy("work").pivot("entry", [*entries]).agg(F.first("value"))
    return wide.select("work", *entries, F.concat_ws(". ", *entries).alias("statement"))


def hooks(df: DataFrame, registry: dict[str, list], when: str) -> DataFrame:
    """UX1: applies the registered DataFrame functions of a hook (bootstrap, preprocess, postprocess) in order."""
    for f in registry.get(when, []):
        df = df.transform(f)
    return df


def transcode(s: Column, function, skip: str | None = None) -> Column:  # noqa: ANN001
    """UX3/SF21: a user's str -> str function on texts, batch by batch; what `skip` matches is passed over."""
    import re

    guard = re.compile(skip) if skip else None

    @F.pandas_udf("string")
    def run(t: pd.Series) -> pd.Series:
        def one(x: str | None) -> str | None:
            if x is None or guard is None:
                return None if x is None else function(x)
            out, at = [], 0
            for m in guard.finditer(x):
                out += [function(x[at : m.start()]), m[0]]
                at = m.end()
            return "".join([*out, function(x[at:])])

        return t.map(one)

    return run(s)
