"""Selections in node tables (F1, F2): steps along the axes of a tree as joins on document order, and what is built on them.

A node table has work, pre, post (the last pre within a node), parent, depth, kind (`element` or `text`), name, attrs and text. A step
takes a selection of nodes (at least work and pre) and gives the nodes that its axis reaches, each once, with all columns of the table:

    verses = step(nodes, roots(nodes), "descendant", "verse")
    notes = step(nodes, verses, "child", "note", F.col("attrs")["type"] == "x")

A predicate is a column; one that asks for other nodes is a selection of its own, kept by having() or left out by lacking().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import decode_ref, split_ref
from quire.operators.ranges import in_range

KEY = ["work", "pre"]
AXES = ("self", "child", "parent", "descendant", "descendant-or-self", "ancestor", "ancestor-or-self", "following-sibling", "preceding-sibling")


def roots(nodes: DataFrame) -> DataFrame:
    return nodes.filter(F.col("parent").isNull() & (F.col("kind") == "element"))


def having(selection: DataFrame, other: DataFrame) -> DataFrame:
    """RG8: the nodes of a selection that are in another too (intersect)."""
    return selection.join(other.select(*KEY).distinct(), KEY, "left_semi").select(*selection.columns)


def lacking(selection: DataFrame, other: DataFrame) -> DataFrame:
    """RG8: the nodes of a selection that are not in another (except)."""
    return selection.join(other.select(*KEY), KEY, "left_anti").select(*selection.columns)


def either(selection: DataFrame, *others: DataFrame) -> DataFrame:
    """RG8: the nodes of any of the selections, each once (the union bar)."""
    out = selection
    for other in others:
        out = out.unionByName(other)
    return out.dropDuplicates(KEY)


def step(nodes: DataFrame, selection: DataFrame, axis: str, name: str | None = None, where: Column | None = None) -> DataFrame:
    """the nodes that an axis reaches from any node of a selection, elements of a name if it is given, that pass a predicate.

    child, parent and the siblings are equi-joins on numbers; descendant and ancestor are containment of pre in pre + 1 .. post, by the
    blocks of in_range(), so what is shuffled is near the input and the result. Repeated nodes of a selection count once; a document
    that is not well-formed (kind `error`) has no nodes."""
    if axis not in AXES:
        raise ValueError(f"unknown axis: {axis}")
    nodes = nodes.filter(F.col("kind") != "error")
    asked = nodes if name is None else nodes.filter(F.col("name") == name)
    asked = asked if where is None else asked.filter(where)
    at = having(nodes, selection)
    if axis == "self":
        return having(asked, at)
    if axis == "child":
        return asked.join(at.select("work", F.col("pre").alias("parent")), ["work", "parent"], "left_semi").select(*nodes.columns)
    if axis == "parent":
        return having(asked, at.select("work", F.col("parent").alias("pre")))
    if axis.endswith("sibling"):
        edge = F.min if axis.startswith("following") else F.max
        ends = at.filter("parent IS NOT NULL").groupBy("work", "parent").agg(edge("pre").alias("edge_"))
        near = asked.join(ends, ["work", "parent"])
        return near.filter(F.col("pre") > F.col("edge_") if axis.startswith("following") else F.col("pre") < F.col("edge_")).select(*nodes.columns)
    if axis.startswith("descendant"):
        spans = at.select("work", (F.col("pre") + (0 if axis.endswith("self") else 1)).alias("low_"), F.col("post").alias("high_"))
        return having(asked, in_range(asked.select(*KEY), spans, "pre", "low_", "high_", ["work"]))
    points = at.select("work", F.col("pre").alias("point_"))
    spans = asked.select(*KEY, (F.col("pre") + (0 if axis.endswith("self") else 1)).alias("low_"), F.col("post").alias("high_"))
    return having(asked, in_range(points, spans, "point_", "low_", "high_", ["work"]))


def nearest(nodes: DataFrame, selection: DataFrame, axis: str, name: str | None = None, where: Column | None = None) -> DataFrame:
    """The nodes of a selection (work, pre) each with the nearest node of `ancestor` (innermost) or `child` (first) as found (its pre);
    null where there is none: `ancestor::x[1]`, `child::x[1]`."""
    asked = nodes.filter(F.col("kind") != "error")
    asked = asked if name is None else asked.filter(F.col("name") == name)
    asked = asked if where is None else asked.filter(where)
    at = selection.select(*KEY).distinct()
    if axis == "ancestor":
        spans = asked.select("work", F.col("pre").alias("found"), (F.col("pre") + 1).alias("low_"), F.col("post").alias("high_"))
        best = in_range(at, spans, "pre", "low_", "high_", ["work"]).groupBy(*KEY).agg(F.max("found").alias("found"))
    elif axis == "child":
        best = asked.groupBy("work", F.col("parent").alias("pre")).agg(F.min(asked["pre"]).alias("found"))
    else:
        raise ValueError(f"unknown axis: {axis}")
    return at.join(best, KEY, "left")


def chains(nodes: DataFrame, selection: DataFrame) -> DataFrame:
    """AL5: (work, pre, chain) with the names of the elements around each node of a selection, outermost first (empty for a root)."""
    at = selection.select(*KEY).distinct()
    spans = nodes.filter(F.col("kind") == "element").select("work", F.struct(F.col("pre").alias("at"), "name").alias("outer"), (F.col("pre") + 1).alias("low_"), F.col("post").alias("high_"))
    found = in_range(at, spans, "pre", "low_", "high_", ["work"]).groupBy(*KEY).agg(F.transform(F.array_sort(F.collect_list("outer")), lambda x: x["name"]).alias("chain"))
    return at.join(found, KEY, "left").withColumn("chain", F.coalesce("chain", F.array().cast("array<string>")))


def texts_to_search(nodes: DataFrame, only: DataFrame | None = None, skip: DataFrame | None = None, header: str = "header") -> DataFrame:
    """text nodes that an annotator looks at: not blank, not within a header element, within a node of `only` if it is given, and then
    not within a node of `skip`. A selection of a text node itself counts like one of an element around it."""
    said = nodes.filter((F.col("kind") == "text") & F.col("text").rlike("\\S"))
    within = lambda s: step(nodes, s, "descendant-or-self")
    said = lacking(said, within(nodes.filter((F.col("kind") == "element") & (F.col("name") == header))))
    if only is not None:
        said = having(said, within(only))
    return said if skip is None else lacking(said, within(skip))


def module_findings(keywords: DataFrame, links: DataFrame, sources: DataFrame, files: DataFrame, work: str) -> DataFrame:
    """JN18: what a keyed module can't have, as (finding, what, n): `duplicate keyword` (keywords: keyword), `empty target` and `missing
    target` (links: ref, a list of ids; those of this work, decoded, must be keywords), `missing file` (sources: src; files: path)."""
    twice = keywords.groupBy("keyword").count().filter("count > 1").select(F.lit("duplicate keyword").alias("finding"), F.col("keyword").alias("what"), F.col("count").alias("n"))
    count = lambda df, said: df.groupBy("what").count().select(F.lit(said).alias("finding"), "what", F.col("count").alias("n"))
    empty = count(links.filter(F.coalesce(F.trim("ref"), F.lit("")) == "").select(F.lit("").alias("what")), "empty target")
    atoms = links.select(F.explode(F.split("ref", "\\s+")).alias("what")).filter("what <> ''")
    prefix, rest = split_ref(F.col("what"))
    mine = atoms.filter(prefix == work).withColumn("key_", decode_ref(rest))
    if not keywords.take(1):  # a work without keywords is not checked
        mine = mine.limit(0)
    gone = count(mine.join(keywords.select(F.col("keyword").alias("key_")).distinct(), "key_", "left_anti").select("what"), "missing target")
    lost = count(sources.filter("src IS NOT NULL").select(F.col("src").alias("what")).join(files.select(F.col("path").alias("what")).distinct(), "what", "left_anti"), "missing file")
    return twice.unionAll(empty).unionAll(gone).unionAll(lost)
