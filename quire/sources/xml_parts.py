"""XML documents in parts: a document that is cut anywhere into rows is shredded without putting it together.

1. Parts are cut anew before a `<`: what stands ahead of a part's first one goes to the part before. No delimiter is cut then, and a
   part begins in text, a comment, a CDATA section, an instruction or a document type. Each part says where it ends for each of these
   five; a document's chain of these answers (a few letters a part) tells where every part begins.
2. Parts are cut anew before their first tag, so that a run of text, with the comments and CDATA within it, is in one part.
3. Each part reads its tags with a stack of its own. What it opens and does not close, closes and did not open, and how many nodes it
   has, are a few rows: sums of the parts before give numbers and depths, and ends meet beginnings by depth and turn.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.operators.scan import Scan, ordered
from quire.plans.graph import checkpoints

#: Where a part may begin, and what ends each but text.
STATES = "tcdpy"
ENDS = {"c": re.compile("-->"), "d": re.compile("]]>"), "p": re.compile(r"\?>"), "y": re.compile(r"]\s*>")}
#: A tag with its quoted values; no `<` is in one.
TAG = re.compile(r"<(/?)([^\s<>/=\"'!?]+)((?:\s+[^\s<>/=\"']+\s*=\s*(?:\"[^\"<]*\"|'[^'<]*'))*)\s*(/?)>")
ATTRIBUTE = re.compile(r"([^\s=]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)')")
REFERENCE = re.compile("&(#x[0-9A-Fa-f]+|#[0-9]+|[^;&<]*)(;?)")
# The entities that XML itself has.
ENTITIES = {"lt": "<", "gt": ">", "amp": "&", "quot": '"', "apos": "'"}


class Malformed(ValueError):
    pass


def pieces(text: str, state: str) -> Iterator[tuple[str, int, int]]:
    """(kind, begin, end): text (`t`), CDATA content (`d`), tags (`<`) and, as the last, where the text ends (`=` and its state in
    STATES). Comments, instructions and document types are passed over."""
    at = 0
    while at < len(text):
        if state != "t":
            m = ENDS[state].search(text, at)
            end = m.start() if m else len(text)
            if state == "d":
                yield "d", at, end
            if not m:
                break
            at, state = m.end(), "t"
            continue
        mark = text.find("<", at)
        if mark != at:
            yield "t", at, mark if mark >= 0 else len(text)
        if mark < 0:
            break
        if text.startswith("<!--", mark):
            at, state = mark + 4, "c"
        elif text.startswith("<![CDATA[", mark):
            at, state = mark + 9, "d"
        elif text.startswith("<?", mark):
            at, state = mark + 2, "p"
        elif text.startswith("<!DOCTYPE", mark):
            plain = re.compile(r"[^\[>]*>").match(text, mark)
            at, state = (plain.end(), "t") if plain else (mark + 9, "y")
        else:
            m = TAG.match(text, mark)
            yield "<", mark, m.end() if m else -1
            if not m:
                at = mark + 1  # told as malformed; other states than the true one may pass here
                continue
            at = m.end()
    yield "=", STATES.index(state), 0


def last_state(text: str, state: str) -> str:
    return next(STATES[b] for kind, b, _ in pieces(text, state) if kind == "=")


def first_tag(text: str, state: str) -> int:
    """Where the first tag begins; the text's length if there is none."""
    return next((b for kind, b, _ in pieces(text, state) if kind == "<"), len(text))


def plain(text: str) -> str:
    """Text with its references resolved and its line ends made one."""

    def one(m: re.Match) -> str:
        name, end = m.groups()
        if not end or not (name.startswith("#") or name in ENTITIES):
            raise Malformed("undefined entity")
        return ENTITIES[name] if name in ENTITIES else chr(int(name[2:], 16) if name[1] == "x" else int(name[1:]))

    return REFERENCE.sub(one, text.replace("\r\n", "\n").replace("\r", "\n"))


def local(name: str) -> str:
    return name.rpartition(":")[2]


def attributes(text: str) -> dict[str, str]:
    out = {}
    for k, a, b in ATTRIBUTE.findall(text):
        if k != "xmlns" and not k.startswith("xmlns:"):
            out[local(k)] = plain(re.sub("[\t\n\r]", " ", (a or b).replace("\r\n", "\n")))
    return out


def read(text: str, state: str) -> tuple[list[list], list[tuple[str, int]], int, int, str]:
    """A part's nodes as [pre, post or None, parent or None, depth, kind, name, attrs, text], the ends (name, depth, nodes before) of
    what it did not open, its number of nodes, its depth at the end, and a complaint. pre, depth and parent count from the part."""
    rows: list[list] = []
    ends: list[tuple[str, int, int]] = []
    open_: list[int] = []
    depth, said, wrong = 0, [], ""

    def flush() -> None:
        if said:
            rows.append([len(rows), len(rows), open_[-1] if open_ else None, depth, "text", None, None, "".join(said)])
            said.clear()

    try:
        for kind, a, b in pieces(text, state):
            if kind == "t":
                said.append(plain(text[a:b]))
            elif kind == "d":
                said.append(text[a:b].replace("\r\n", "\n").replace("\r", "\n"))
            elif kind == "<":
                if b < 0:
                    raise Malformed("not well-formed")
                flush()
                shut, name, given, empty = TAG.match(text, a).groups()
                if shut:
                    depth -= 1
                    if open_:
                        i = open_.pop()
                        if rows[i][8] != name:
                            raise Malformed("mismatched tag")
                        rows[i][1] = len(rows) - 1
                    else:
                        ends.append((name, depth, len(rows)))
                else:
                    at = len(rows)
                    rows.append([at, at if empty else None, open_[-1] if open_ else None, depth, "element", local(name), attributes(given), None, name])
                    if not empty:
                        open_.append(at)
                        depth += 1
            elif STATES[a] not in "t":
                wrong = "unclosed token"
        flush()
    except (Malformed, ValueError, OverflowError) as e:
        wrong = str(e)
    return rows, ends, len(rows), depth, wrong


NODE = "work string, pre int, post int, parent int, depth int, kind string, name string, attrs map<string,string>, text string"


def _merged(parts: DataFrame, cut: str) -> DataFrame:
    """Parts (work, part, text, ...) cut anew: the first `cut` characters of a part go to the last part before that keeps some. The
    document's first part keeps what it has."""
    # places only: the texts of a document never come together
    narrow = parts.select("work", "part", F.col(cut).alias("cut"), (F.col(cut) < F.length("text")).alias("full"))
    seen = ordered(narrow, ["work"], ["part"], {"nth": Scan("number")})
    seen = seen.withColumn("keeps", F.col("full") | (F.col("nth") == 1)).withColumn("cut", F.when(F.col("nth") == 1, 0).otherwise(F.col("cut")))
    before = ordered(seen, ["work"], ["part"], {"before": Scan("before", F.when(F.col("keeps"), F.col("part")))})
    owned = ordered(before, ["work"], ["part"], {"ahead": Scan("last", F.col("before"))}).select("work", "part", "cut", "keeps", "ahead")
    both = parts.select("work", "part", "text").join(owned, ["work", "part"])
    head = both.filter("cut > 0").select("work", F.col("ahead").alias("part"), F.col("part").alias("place"), F.expr("substring(text, 1, cut)").alias("text"))
    rest = both.filter("keeps").select("work", "part", F.col("part").alias("place"), F.expr("substring(text, cut + 1)").alias("text"))
    told = head.unionAll(rest).groupBy("work", "part").agg(F.array_sort(F.collect_list(F.struct("place", "text"))).alias("all"))
    return told.select("work", "part", F.array_join(F.transform("all", lambda x: x["text"]), "").alias("text"))


def shred_parts(parts: DataFrame, work: str, part: str, text: str) -> DataFrame:
    """SC5/D2: the node table of documents whose text is cut into rows (work, part, text) in the order of part, anywhere: as shred() of
    the whole text gives it. pre numbers nodes from 0, post is the last pre within a node.

    A row holds a part, and what is larger than one (a run of text, a tag) with the parts that it reaches into; a document's parts
    cost a few letters each in one task, and an ancestor that stays open a row in each part that ends within it. Comments, instructions
    and document types are no nodes; prefixes are dropped; entities are XML's own. A document that is not well-formed gives one row of
    kind `error`. Null texts count as empty; a work or part that is null is left out."""
    spark = parts.sparkSession
    checkpoints(spark)
    raw = parts.select(F.col(work).cast("string").alias("work"), F.col(part).cast("long").alias("part"), F.coalesce(F.col(text), F.lit("")).alias("text")).filter("work IS NOT NULL AND part IS NOT NULL")
    at = F.locate("<", F.col("text"))
    marked = _merged(raw.withColumn("cut", F.when(at > 0, at - 1).otherwise(F.length("text"))), "cut").checkpoint()

    def answers(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield pd.DataFrame({"work": pdf["work"], "part": pdf["part"], "next": ["".join(last_state(t, s) for s in STATES) for t in pdf["text"]]})

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, state, out = pdf.sort_values("part"), "t", []
        for step in pdf["next"]:
            out.append(state)
            state = step[STATES.index(state)]
        return pd.DataFrame({"work": pdf["work"], "part": pdf["part"], "state": out})

    states = marked.mapInPandas(answers, "work string, part long, next string").groupBy("work").applyInPandas(chain, "work string, part long, state string")

    def tags(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield pdf.assign(cut=[first_tag(t, s) for t, s in zip(pdf["text"], pdf["state"], strict=True)])

    told = marked.join(states, ["work", "part"]).mapInPandas(tags, "work string, part long, text string, state string, cut int")
    whole = _merged(told, "cut")
    # a part that begins with its first tag begins in text; the first one of a document always does

    def nodes(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """what: `node`, `end` (pre: nodes before it) and `part` (pre: its nodes, depth: its depth at the end, text: a complaint)."""
        names = ["work", "part", "what", "pre", "post", "parent", "depth", "kind", "name", "attrs", "text", "tag"]
        for pdf in it:
            for w, p, t in zip(pdf["work"], pdf["part"], pdf["text"], strict=True):
                rows, ends, n, depth, wrong = read(t, "t")
                out = [(w, p, "node", r[0], r[1], r[2], r[3], r[4], r[5], r[6], r[7], r[8] if len(r) > 8 else None) for r in rows]
                out += [(w, p, "end", n_, i, None, d, None, None, None, None, name) for i, (name, d, n_) in enumerate(ends)]
                out.append((w, p, "part", n, None, None, depth, None, None, None, wrong or None, None))
                for k in range(0, len(out), 20_000):
                    yield pd.DataFrame(out[k : k + 20_000], columns=names).astype({c: "Int64" for c in ("pre", "post", "parent", "depth")})

    kinds = "work string, part long, what string, pre long, post long, parent long, depth long, kind string, name string, attrs map<string,string>, text string, tag string"
    found = whole.mapInPandas(nodes, kinds).checkpoint()
    before = Window.partitionBy("work").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    offsets = found.filter("what = 'part'").select("work", "part", F.coalesce(F.sum("pre").over(before), F.lit(0)).alias("n0"), F.coalesce(F.sum("depth").over(before), F.lit(0)).alias("d0"))
    placed = found.filter("what <> 'part'").join(offsets, ["work", "part"]).withColumn("pre", F.col("pre") + F.col("n0")).withColumn("depth", F.col("depth") + F.col("d0"))
    placed = placed.withColumn("post", F.when(F.col("what") == "node", F.col("post") + F.col("n0")).otherwise(F.col("post"))).withColumn("parent", F.col("parent") + F.col("n0")).drop("n0", "d0").checkpoint()
    # ends and beginnings at one depth take turns
    turn = Scan("number")
    begun = ordered(placed.filter("what = 'node' AND post IS NULL").select("work", "depth", "pre", "tag"), ["work", "depth"], ["pre"], {"turn": turn})
    # of the ends of one part those further out come later
    ended = ordered(placed.filter("what = 'end'").select("work", "depth", "part", F.col("post").alias("nth"), (F.col("pre") - 1).alias("last"), F.col("tag").alias("end_tag")), ["work", "depth"], ["part", "nth"], {"turn": turn})
    met = begun.join(ended.drop("part", "nth"), ["work", "depth", "turn"], "full").checkpoint()
    # a node without a parent in its part is within the last one opened before it, one level up: asked once for each part and level
    opened = placed.filter("what = 'node' AND post IS NULL").select("work", F.col("depth").alias("level"), F.col("pre").alias("at"), F.lit(0).alias("asks"), "pre", F.lit(None).cast("long").alias("part"))
    asked = placed.filter("what = 'node' AND parent IS NULL AND depth > 0").groupBy("work", "part", (F.col("depth") - 1).alias("level")).agg(F.min("pre").alias("at"))
    line = opened.unionByName(asked.select("work", "level", "at", F.lit(1).alias("asks"), F.lit(None).cast("long").alias("pre"), "part"))
    answered = ordered(line, ["work", "level"], ["at", "asks"], {"above": Scan("last", F.col("pre"))}).filter("asks = 1").select("work", "part", (F.col("level") + 1).alias("depth"), "above")
    node = placed.filter("what = 'node'").join(answered, ["work", "part", "depth"], "left").join(met.filter("pre IS NOT NULL").select("work", "pre", "last"), ["work", "pre"], "left")
    # complaints: of parts, ends that meet no beginning or one of another name, text or elements beside the root
    blank = F.col("text").rlike("^[ \\t\\n]*$")
    roots = placed.filter("what = 'node' AND depth = 0")
    odd = [
        found.filter("what = 'part' AND text IS NOT NULL").select("work", F.col("text").alias("said")),
        met.filter("pre IS NULL OR last IS NULL OR tag <> end_tag").select("work", F.lit("mismatched tag").alias("said")),
        roots.filter((F.col("kind") == "text") & ~blank).select("work", F.lit("junk beside the root").alias("said")),
        roots.groupBy("work").agg(F.count(F.when(F.col("kind") == "element", 1)).alias("n")).filter("n > 1").select("work", F.lit("junk beside the root").alias("said")),
        raw.select("work").distinct().join(roots.filter("kind = 'element'").select("work").distinct(), "work", "left_anti").select("work", F.lit("no element found").alias("said")),
        placed.filter("depth < 0").select("work", F.lit("mismatched tag").alias("said")),
    ]
    wrong = odd[0]
    for more in odd[1:]:
        wrong = wrong.unionAll(more)
    wrong = wrong.groupBy("work").agg(F.min("said").alias("said")).checkpoint()
    # white space beside the root is no node: those ahead of it shift the numbers
    stray = placed.filter("what = 'node' AND depth = 0 AND kind = 'text'").groupBy("work").agg(F.min("pre").alias("p"), F.max("pre").alias("q"))
    head = stray.select("work", F.when(F.col("p") == 0, 1).otherwise(0).alias("ahead"))
    node = node.filter("NOT (depth = 0 AND kind = 'text')").join(wrong.select("work"), "work", "left_anti").join(head, "work", "left").withColumn("ahead", F.coalesce("ahead", F.lit(0)))
    less = lambda c: (c - F.col("ahead")).cast("int")
    out = node.select("work", less(F.col("pre")).alias("pre"), less(F.coalesce("post", "last")).alias("post"), less(F.coalesce("parent", "above")).alias("parent"), F.col("depth").cast("int").alias("depth"), "kind", "name", "attrs", "text")
    none = lambda t: F.lit(None).cast(t)
    bad = wrong.select("work", F.lit(0), F.lit(0), none("int"), F.lit(0), F.lit("error"), none("string"), none("map<string,string>"), "said")
    return out.unionAll(bad.toDF(*out.columns))
