"""The reference linker: finds extended references in text, splits them, and resolves each part by its context.

Thirteen forms, tried in a fixed order; the first that matches the whole part decides. A part without a book or chapter
takes it from the part before it, and a bare number is a chapter or a verse by what came before.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Books of one chapter.
ONE_CHAPTER = ("Obad", "Phlm", "Jude", "2John", "3John")
MOST_FIXES = 100_000
SLICE = 64
DIGIT = re.compile("\\d")
LINK = "array<struct<start:int,end:int,text:string,type:string,book:string,ch:int,vs:int,lv:int,ref:string,status:string>>"


@dataclass(frozen=True)
class Settings:
    """Terms are regular expressions. books: name to code."""

    books: dict[str, str]
    chapter_to_verse: str = ":"
    continuation: str = "-"
    chapter_terms: tuple[str, ...] = ("chapter", "chap\\.", "ch\\.")
    verse_terms: tuple[str, ...] = ("verses", "verse", "vv\\.", "v\\.")
    current_chapter: tuple[str, ...] = ("this chapter",)
    current_book: tuple[str, ...] = ("this book",)
    separators: tuple[str, ...] = (";", ",", "and")
    suffixes: str = "\\.?"
    prefixes: tuple[str, ...] = ("see", "cf\\.")
    ref_end: str = "(?=[\\s.,;:)\\]!?]|$)"
    one_chapter: tuple[str, ...] = ONE_CHAPTER
    cross_chapter: bool = False


@dataclass
class Grammar:
    s: Settings
    forms: list[tuple[str, re.Pattern]] = field(default_factory=list)

    def __post_init__(self) -> None:
        s = self.s
        names = "|".join(re.escape(b) for b in sorted(s.books, key=lambda b: (-len(b), b)))
        alt = lambda terms: "(?:" + "|".join(terms) + ")" if terms else "(?!)"
        book = f"(?P<book>(?:{names}|{'|'.join(s.current_book)}){s.suffixes})"
        maybe = f"(?:{book}\\s*)?"
        chap, verse, here = alt(s.chapter_terms), alt(s.verse_terms), alt(s.current_chapter)
        either = f"(?:{book}|(?P<here>{here}))"
        c, v, w = "(?P<ch>\\d{1,3})", "(?P<vs>\\d{1,3})", "(?P<lv>\\d{1,3})"
        cv, dash = f"\\s*{s.chapter_to_verse}\\s*", f"\\s*{s.continuation}\\s*"
        shapes = [
            ("T01", f"{maybe}{c}{cv}{v}{dash}(?P<lch>\\d{{1,3}}){cv}{w}"),
            ("T02", f"{maybe}{c}{cv}{v}{dash}{w}"),
            ("T03", f"{maybe}{c}{cv}{v}"),
            ("T04", f"{maybe}{c}\\s*{chap}\\s*{v}(?:{dash}{w})?\\s*{verse}"),
            ("T05", f"{maybe}{c}{dash}(?P<lch>\\d{{1,3}})\\s*{chap}"),
            ("T06", f"{maybe}{c}\\s*{chap}"),
            ("T07", f"(?:{either}\\s*)?{v}{dash}{w}\\s*{verse}"),
            ("T08", f"(?:{either}\\s*)?{v}\\s*{verse}"),
            ("T09", f"{either}\\s*(?P<n>\\d{{1,3}})(?:{dash}(?P<m>\\d{{1,3}}))?"),
            ("T11", f"{maybe}{chap}\\s*{c}[\\s,]*{verse}\\s*{v}"),
            ("T12", f"{maybe}{chap}\\s*{c}"),
            ("T13", f"(?:{either}\\s*)?{verse}\\s*{v}(?:{dash}{w})?"),
            ("T10", f"(?P<n>\\d{{1,3}})(?:{dash}(?P<m>\\d{{1,3}}))?"),
        ]
        self.forms = [(t, re.compile(p, re.I)) for t, p in shapes]
        bare = lambda p: re.sub(r"\?P<\w+>", "?:", p)
        # where any form but T10 begins, in one search; and all forms at once, each with groups of its own
        self.begin = re.compile(f"(?<![^\\W_])(?:{'|'.join(bare(p) for t, p in shapes if t != 'T10')})", re.I)
        self.whole = re.compile("|".join(f"(?P<{t}>{re.sub(r'\?P<(\w+)>', lambda m, t=t: f'?P<{t}_{m[1]}>', p)})" for t, p in shapes), re.I)
        more = "|".join([names, chap, verse, here, alt(s.current_book), alt(s.prefixes), alt(s.separators), s.chapter_to_verse, s.continuation, "\\d+", "\\s+", "\\."])
        self.extension = re.compile(f"(?:{more})*", re.I)
        self.end = re.compile(s.ref_end, re.I)
        self.split = re.compile(f"(\\s*(?:{'|'.join(s.separators)})\\s*)", re.I)
        self.code = {k.lower(): v for k, v in s.books.items()}

    def book_of(self, name: str | None, now: str | None) -> str | None:
        if name is None:
            return now
        bare = re.sub(f"(?:{self.s.suffixes})$", "", name) or name
        return self.code.get(name.lower(), self.code.get(bare.lower(), now))


def locate(g: Grammar, text: str, at: int) -> tuple[int, int] | None:
    """The leftmost match of any form but T10; of those that start there the shortest. What is behind a match is searched from there,
    so a text is read about once, however many matches it has."""
    m = g.begin.search(text, at)
    if not m:
        return None
    ends = [x.end() for name, p in g.forms if name != "T10" and (x := p.match(text, m.start()))]
    return m.start(), min(ends)


def resolve(g: Grammar, part: str, book: str | None, ch: int | None, verses: bool) -> tuple[dict, str | None, int | None, bool] | None:
    """AN2/WN3: a part by the first form that matches it whole: its fields, and the context behind it, which the next part inherits (its
    book, chapter, and whether a bare number is a verse)."""
    # alternatives are tried in the order of the forms
    m = g.whole.fullmatch(part)
    if m:
        name = next(t for t, _ in g.forms if m[t] is not None)
        found = m.groupdict()
        d = {k: found.get(f"{name}_{k}") for k in ("book", "ch", "vs", "lv", "lch", "n", "m", "here")}
        num = {k: int(d[k]) if d[k] else None for k in ("ch", "vs", "lv", "lch", "n", "m")}
        b = g.book_of(d["book"], book)
        c, v, last = num["ch"], num["vs"], num["lv"]
        mode = verses
        if name == "T01":
            mode = False
            if num["lch"] != c and not g.s.cross_chapter:
                last = None
        elif name in ("T02", "T03", "T11", "T13", "T07", "T08"):
            mode = True
        elif name in ("T04", "T05"):
            mode = False
        if name in ("T07", "T08", "T13"):
            c = ch if d["book"] is None else (1 if b in g.s.one_chapter else ch)
        if name == "T09":
            if d["here"] or b in g.s.one_chapter:
                c, v, last, mode = (1 if b in g.s.one_chapter else ch), num["n"], num["m"], True
            else:
                c, mode = num["n"], False
        if name == "T10":
            if verses:
                c, v, last = ch, num["n"], num["m"]
            else:
                c, v = num["n"], None
        if b is None or c is None:
            return None
        if v == 0 and b == "Ps":
            v = 1
        if last is not None and (v is None or (last <= v and not (name == "T01" and num["lch"] != c))):
            last = None
        tail = f".{v}" if v is not None else ""
        ref = f"{b}.{c}{tail}" + (f"-{b}.{num['lch'] if name == 'T01' and g.s.cross_chapter else c}.{last}" if last is not None else "")
        return {"type": name, "book": b, "ch": c, "vs": v, "lv": last, "ref": ref}, b, c, mode
    return None


def find(g: Grammar, text: str, book: str | None = None, ch: int | None = None, fixes: dict[str, str] | None = None) -> list[dict]:
    """All references of a text. book and ch: where the text stands. fixes: an extended reference's text to its
    replacement, or to the empty text to leave it alone (AN4)."""
    out: list[dict] = []
    at = 0
    while found := locate(g, text, at):
        start, end = found
        stretch = g.extension.match(text, end)
        stop = stretch.end() if stretch else end
        while stop > end and not g.end.match(text, stop):
            stop -= 1
        whole = text[start:stop].rstrip()
        while whole and (m := re.search(f"(?:\\s|{'|'.join(g.s.separators)}|\\.)$", whole, re.I)) and m.start() >= end - start:
            whole = whole[: m.start()].rstrip()
        at = start + max(1, len(whole))
        if not g.end.match(text, start + len(whole)):
            word = re.compile(r"\S+\s*").match(text, start)
            at = word.end() if word else start + 1
            continue
        if not any(c.isdigit() for c in whole):
            continue
        source = whole
        if fixes is not None and whole in fixes:
            if not fixes[whole]:
                continue
            source = fixes[whole]
        now, chapter = book, ch
        verses = now in g.s.one_chapter
        chapter = 1 if verses else chapter
        place = 0
        for i, part in enumerate(g.split.split(source)):
            if i % 2 == 0 and part.strip():
                lead = len(part) - len(part.lstrip())
                got = resolve(g, part.strip(), now, chapter, verses)
                a, b = (start + place + lead, start + place + lead + len(part.strip())) if source == whole else (start, start + len(whole))
                if got:
                    fields, now, chapter, verses = got
                    out.append({"start": a, "end": b, "text": text[a:b], "status": "ok", **fields})
                else:
                    out.append({"start": a, "end": b, "text": text[a:b], "status": "unresolved", "type": None, "book": None, "ch": None, "vs": None, "lv": None, "ref": None})
            place += len(part)
    return out


def link_references(df: DataFrame, text: str, settings: Settings, book: str | None = None, ch: str | None = None, fixes: DataFrame | None = None) -> DataFrame:
    """AN1-AN4/UX8: df with `links`, an array of links of each text. book, ch: columns of the text's own place. fixes: a small table (found, instead).

    Texts without a digit never reach Python's grammar. Texts are taken from their batch one by one, and links packed every SLICE
    texts, so a task holds one batch as it came, and few Python objects."""
    table = None
    if fixes is not None:
        rows = fixes.limit(MOST_FIXES + 1).collect()
        if len(rows) > MOST_FIXES:
            raise ValueError(f"more than {MOST_FIXES} fixes; they are a hand-made table that goes to every task")
        table = {r.found: r.instead for r in rows}

    made: list[Grammar] = []  # of a task: its batches share it

    @F.arrow_udf(LINK)
    def run(t: pa.Array, b: pa.Array, c: pa.Array) -> pa.Array:
        if not made:
            made.append(Grammar(settings))
        g = made[0]
        numbers, kind = {"start", "end", "ch", "vs", "lv"}, ("start", "end", "text", "type", "book", "ch", "vs", "lv", "ref", "status")
        links = pa.list_(pa.struct([(k, pa.int32() if k in numbers else pa.string()) for k in kind]))

        def one(n: int) -> list[dict]:
            text = t[n].as_py()
            return [] if text is None or not DIGIT.search(text) else find(g, text, b[n].as_py(), c[n].as_py(), table)

        parts = [pa.array([one(n) for n in range(k, min(k + SLICE, len(t)))], links) for k in range(0, len(t), SLICE)]
        return pa.concat_arrays(parts) if parts else pa.array([], links)

    null = lambda kind: F.lit(None).cast(kind)
    # not repeated in filters that an explode of the links would infer below the exchange
    once = run.asNondeterministic()
    return spread(df).withColumn("links", once(F.col(text), F.col(book) if book else null("string"), F.col(ch).cast("int") if ch else null("int")))


def explicit_references(df: DataFrame, text: str, target: str, settings: Settings, codes: dict[str, str], book: str, ch: str) -> DataFrame:
    """AN3: df with `ref`, what an explicit reference element means: its target attribute (`GEN 2:1`, codes: abbreviation to book) if it
    has one, a bare number by its context, else the first reference that the grammar finds in its text."""
    g = lambda i: F.nullif(F.regexp_extract(target, "^\\s*(\\w{3})\\s+(\\d+)(?:[:.](\\d+))?", i), F.lit(""))
    known = F.create_map(*(F.lit(x) for kv in codes.items() for x in kv))
    aimed = F.when(g(1).isNotNull(), F.concat_ws(".", F.element_at(known, F.upper(g(1))), g(2), g(3)))
    bare = F.when(F.col(text).rlike("^\\s*\\d+\\s*$"), F.concat_ws(".", F.col(book), F.col(ch).cast("string"), F.trim(text)))
    return link_references(df, text, settings, book, ch).withColumn("ref", F.coalesce(aimed, bare, F.get("links", 0)["ref"])).drop("links")


def spread(df: DataFrame) -> DataFrame:
    """df dealt over all cores where it has fewer partitions: the grammar costs far more than the exchange."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def fix_report(fixes: DataFrame, links: DataFrame) -> DataFrame:
    """AN4: fixes (location, found, instead) that no link at their location used."""
    return fixes.join(links.select("location", F.col("text").alias("found")).distinct(), ["location", "found"], "left_anti")


def footnote_links(notes: DataFrame, mentions: DataFrame, verse: str) -> DataFrame:
    """AN11/JN15: mentions (verse, ordinal: n from 1, -1 the last, 0 the one before the mention, at: its place) to notes (verse, at, note_id).

    The N-th of a verse by its place; the one before by as-of on the same order."""
    w = Window.partitionBy(verse).orderBy("at")
    n = notes.withColumn("nth", F.row_number().over(w)).withColumn("back", F.row_number().over(Window.partitionBy(verse).orderBy(F.desc("at"))))
    m = mentions.withColumnRenamed("at", "mention_at")
    hit = ((F.col("ordinal") > 0) & (F.col("nth") == F.col("ordinal"))) | ((F.col("ordinal") == -1) & (F.col("back") == 1)) | ((F.col("ordinal") == 0) & (F.col("at") < F.col("mention_at")))
    cand = m.join(n, verse).filter(hit)
    last = Window.partitionBy(*m.columns).orderBy(F.desc("at"))
    return cand.withColumn("__n", F.row_number().over(last)).filter("__n = 1").select(*m.columns, "note_id")
