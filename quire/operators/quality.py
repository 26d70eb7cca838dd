"""Suites of checks, rule overrides, explicit links and what is left of the publication plumbing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FINDING = "severity string, check string, location string, message string"


def finding(df: DataFrame, severity: str, check: str, location: Column, message: Column) -> DataFrame:
    """Rows as findings."""
    return df.select(F.lit(severity).alias("severity"), F.lit(check).alias("check"), location.cast("string").alias("location"), message.cast("string").alias("message"))


def integrity_suite(refs: DataFrame, ids: DataFrame, index: DataFrame) -> DataFrame:
    """DQ2/JN2/JN3/AG8: one table of findings of a view: targets that do not exist, ids given twice, verses outside the verse
    system. refs: location, target, is_verse; ids: id; index: id. Run it on the fitted and the source view alike."""
    lost = refs.join(ids.select(F.col("id").alias("target")).distinct(), "target", "left_anti").filter("NOT is_verse")
    outside = refs.filter("is_verse").join(index.select(F.col("id").alias("target")).distinct(), "target", "left_anti")
    twice = ids.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1")
    return (
        finding(lost, "ERROR", "missing target", F.col("location"), F.col("target"))
        .unionByName(finding(outside, "ERROR", "outside verse system", F.col("location"), F.col("target")))
        .unionByName(finding(twice, "ERROR", "repeated id", F.col("id"), F.col("n")))
    )


def in_verse_system(df: DataFrame, ident: str, index: DataFrame) -> DataFrame:
    """SF17: whether an id is a verse of the system; index: id."""
    have = index.select(F.col("id").alias("__v")).distinct().withColumn("in_system", F.lit(True))
    return df.join(have, F.col(ident) == F.col("__v"), "left").withColumn("in_system", F.coalesce("in_system", F.lit(False))).drop("__v")


def book_facts(df: DataFrame, book: str, books: DataFrame) -> DataFrame:
    """SF15: a book's group and place in it, from a dimension (book, group, place)."""
    return df.join(books, book, "left")


def size_text(n: Column) -> Column:
    """SF27: bytes as B, KB or MB with one decimal."""
    return F.when(n < 1024, F.concat(n.cast("string"), F.lit(" B"))).when(n < 1024**2, F.concat(F.format_number(n / 1024, 1), F.lit(" KB"))).otherwise(F.concat(F.format_number(n / 1024**2, 1), F.lit(" MB")))


def override(matches: DataFrame, node: str, rule: str, value: str, last: bool) -> DataFrame:
    """of the rules that match a node, in the order of their names, the last (context books) or first (work prefixes)
    decides; the value `skip` means none."""
    pick = F.max_by if last else F.min_by
    return matches.groupBy(node).agg(pick(value, rule).alias(value)).withColumn(value, F.when(F.col(value) != "skip", F.col(value)))


def view(nodes: DataFrame, which: str) -> DataFrame:
    """a document in its source or fitted verse system: nodes marked for the other view go, ids are the view's own."""
    own = F.col("src_id") if which == "source" else F.col("fitted_id")
    return nodes.filter(F.col("only_in").isNull() | (F.col("only_in") == which)).withColumn("id", F.coalesce(own, F.col("id")))


def imported(nodes: DataFrame) -> DataFrame:
    """F16: after an import: cells that are numbers are aligned right, empty cells get a no-break space, keywords lose their ends' punctuation."""
    cell, key = F.col("name") == "cell", F.col("name") == "k"
    text = F.when(cell & (F.trim(F.coalesce("text", F.lit(""))) == ""), F.lit(" ")).when(key, F.regexp_replace("text", "^[\\s\\p{Punct}]+|[\\s\\p{Punct}]+$", "")).otherwise(F.col("text"))
    return nodes.withColumn("type", F.when(cell & F.col("text").rlike("^\\s*[\\d.,]+\\s*$"), "x-right").otherwise(F.col("type"))).withColumn("text", text)


def explicit_links(marks: DataFrame, entries: DataFrame) -> DataFrame:
    """AN8: explicit index marks (location, lemma, before) to entries (entry, name, context): an equal name; of several the one whose
    context word stands nearest before the mark, then the smallest. Marks without an entry come back with a null.

    Of the entries of one name and context word only the smallest can be meant, so marks meet a row for each context word of their
    name, however many entries have it."""
    one = entries.groupBy(F.lower("name").alias("__name"), F.lower("context").alias("__context")).agg(F.min(F.struct("entry")).alias("__entry"))
    hit = marks.join(one, F.lower("lemma") == F.col("__name"), "left")
    place = F.when(F.col("__context").isNotNull() & F.contains(F.lower("before"), F.col("__context")), F.length("before") - F.instr(F.reverse(F.lower("before")), F.reverse("__context"))).otherwise(-1)
    best = hit.groupBy("location", "lemma").agg(F.min(F.struct((-place).alias("place"), F.col("__entry.entry").alias("entry"))).alias("__best"))
    return best.select("location", "lemma", F.col("__best.entry").alias("entry"))


def note_targets(notes: DataFrame) -> DataFrame:
    """AN15: a note's target: its own annotation reference, or the last verse before it."""
    w = Window.partitionBy("work", "book").orderBy("pre").rowsBetween(Window.unboundedPreceding, 0)
    verse = F.last(F.when(F.col("name") == "verse", F.col("id")), ignorenulls=True).over(w)
    return notes.withColumn("target", F.when(F.col("name") == "note", F.coalesce("annotate_ref", verse)))


def insertion_points(nodes: DataFrame, verses: DataFrame) -> DataFrame:
    """AN19/JN14: for each verse (book, id, pre, until) the first text node after its start; a verse without text has none."""
    texts = nodes.filter("kind = 'text' AND trim(text) <> ''").select("book", F.col("pre").alias("t"))
    hit = verses.join(texts, "book", "left").filter("t IS NULL OR (t > pre AND t <= until)")
    return verses.select("book", "id").join(hit.groupBy("book", "id").agg(F.min("t").alias("insert_at")), ["book", "id"], "left")


def schema_findings(nodes: DataFrame, rules: DataFrame, allowed: Sequence[str] = ()) -> DataFrame:
    """DQ3: elements that may not stand in their parent. rules: (parent, child) pairs; allowed: messages that are let through."""
    p = nodes.select("work", F.col("pre").alias("parent"), F.col("name").alias("parent_name"))
    kids = nodes.filter("kind = 'element' AND parent IS NOT NULL").join(p, ["work", "parent"])
    bad = kids.join(rules, (F.col("parent_name") == rules["parent"]) & (F.col("name") == rules["child"]), "left_anti")
    out = finding(bad, "ERROR", "schema", F.concat_ws(":", "work", F.col("pre").cast("string")), F.concat_ws(" in ", "name", "parent_name"))
    return out.filter(~F.col("message").isin(*allowed)) if allowed else out


def context_findings(rules: DataFrame, known: DataFrame) -> DataFrame:
    """DQ6: context values (rule, value) that are no known id, book or `all`."""
    ok = known.select(F.col("id").alias("value")).distinct()
    return finding(rules.filter("lower(value) <> 'all'").join(ok, "value", "left_anti"), "ERROR", "context", F.col("rule"), F.col("value"))


def rule_findings(rules: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """DQ7: rule attributes (rule, attribute, value) that are not allowed, and compound names without a work prefix."""
    bad = rules.filter(~F.col("attribute").isin(*allowed))
    bare = rules.filter((F.col("attribute") == "osisRef") & (F.instr("value", ":") == 0))
    return finding(bad, "ERROR", "attribute", F.col("rule"), F.col("attribute")).unionByName(finding(bare, "WARNING", "work prefix", F.col("rule"), F.col("value")))


def leftover_markup(df: DataFrame, key: str, text: str, pattern: str = "\\\\[a-z]+\\d*\\*?") -> DataFrame:
    """DQ10: texts that still have source markers, with the first and their number."""
    return df.filter(F.col(text).rlike(pattern)).select(key, F.regexp_extract(text, f"({pattern})", 1).alias("first"), F.regexp_count(text, F.lit(pattern)).cast("long").alias("n"))


def changed_texts(before: DataFrame, after: DataFrame, key: str, text: str, markup: str = "<[^>]*>") -> DataFrame:
    """DQ11: keys whose text without markup is no longer what it was."""
    bare = lambda d, n: d.select(key, F.regexp_replace(text, markup, "").alias(n))
    return bare(before, "b").join(bare(after, "a"), key, "full_outer").filter("NOT (a <=> b)").select(key)


def dropped_material(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """DQ13: what a step left out, as warnings."""
    return finding(before.join(after.select(key).distinct(), key, "left_anti"), "WARNING", "dropped", F.col(key), F.lit("not in the result"))


def misused_aggregates(refs: DataFrame, aggregates: DataFrame) -> DataFrame:
    """JN19: references to aggregated entries where their parts are meant."""
    return refs.join(aggregates.select(F.col("id").alias("target")).distinct(), "target", "left_semi")


def calls(constant: DataFrame, each: DataFrame) -> DataFrame:
    """JN20: constant arguments beside each call's own. constant has one row."""
    return each.crossJoin(constant)


def toc_places(items: DataFrame) -> DataFrame:
    """RD4: an inline table of contents goes before the first or behind the last item of its parent, as its place says."""
    w = Window.partitionBy("work", "parent")
    return items.withColumn("holds_toc", F.when(F.col("place") == "first", F.col("pre") == F.min("pre").over(w)).otherwise(F.col("pre") == F.max("pre").over(w)))


def header_conf(headers: DataFrame) -> DataFrame:
    """SC23: settings read back from headers (work, key `section+entry` or `entry`, value): the work's own section before MAIN."""
    named = headers.withColumn("section", F.when(F.instr("key", "+") > 0, F.substring_index("key", "+", 1)).otherwise("MAIN")).withColumn("entry", F.substring_index("key", "+", -1))
    return named.groupBy("work", "entry").agg(F.min_by("value", F.when(F.col("section") == F.col("work"), 0).otherwise(1)).alias("value"))


def used_files(files: DataFrame, figures: DataFrame) -> DataFrame:
    """SK12: only the files that a figure refers to."""
    return files.join(figures.select(F.col("src").alias("path")).distinct(), "path", "left_semi")


def cut_siblings(nodes: DataFrame, at: Column) -> DataFrame:
    """TR7: a node's children from the first marked one on become siblings of the node."""
    w = Window.partitionBy("work", "parent").orderBy("pre").rowsBetween(Window.unboundedPreceding, 0)
    moved = F.max(F.when(at, 1).otherwise(0)).over(w) == 1
    up = nodes.select("work", F.col("pre").alias("parent"), F.col("parent").alias("__grand"))
    out = nodes.withColumn("__moved", moved).join(up, ["work", "parent"], "left")
    return out.withColumn("parent", F.when(F.col("__moved"), F.col("__grand")).otherwise(F.col("parent"))).drop("__moved", "__grand")


def rewrite(text: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """UX2: (pattern, replacement, flags) rules instead of code as data; flags i and s only."""
    for pattern, new, flags in rules:
        if set(flags) - {"i", "s"}:
            raise ValueError(f"unknown flags: {flags}")
        text = F.regexp_replace(text, f"(?{flags}){pattern}" if flags else pattern, new)
    return text


def file_name(template: str) -> Column:
    """UX5: a publication's file name from a template with {column} places."""
    import re

    parts = [F.col(x[1:-1]).cast("string") if x.startswith("{") else F.lit(x) for x in re.findall(r"\{\w+\}|[^{]+", template)]
    return F.concat(*parts)


def is_fresh(built: Column, sources: Sequence[Column], hours: float | None = None) -> Column:
    """SC15: whether something built at a time is younger than all its sources and, if given, than so many hours."""
    ok = F.lit(True)
    for s in sources:
        ok = ok & (built >= s)
    return ok & (built >= F.current_timestamp() - F.expr(f"INTERVAL '{int(hours * 3600)}' SECOND")) if hours is not None else ok


def search(texts: DataFrame, key: str, text: str, term: str, around: int = 40) -> DataFrame:
    """AL6: the first line that has a term, in any case, cut to some characters around it."""
    line = F.get(F.filter(F.split(text, "\n"), lambda x: F.lower(x).contains(term.lower())), 0)
    at = F.instr(F.lower(F.col("line")), term.lower())
    begin = F.greatest(at - around, F.lit(1))
    return texts.select(key, line.alias("line")).filter("line IS NOT NULL").select(key, F.substring(F.col("line"), begin, at - begin + len(term) + around).alias("found"))
