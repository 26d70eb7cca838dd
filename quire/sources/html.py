"""HTML pages: links, tags and text runs."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.plans.graph import dealt

#: The characters that stand around a text and are no part of it: all of Unicode's spaces. Within a text only ASCII ones are folded.
_SPACES = " \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


def page_links(pages: DataFrame, key: str, html: str) -> DataFrame:
    """SC17: href targets of anchors without query and fragment, in order (seq from 1)."""
    found = F.regexp_extract_all(F.col(html), F.lit('<a\\s[^>]*?href="([^"]*)"'), F.lit(1))
    rows = pages.select(key, F.posexplode(found).alias("pos", "raw"))
    return rows.select(key, (F.col("pos") + 1).cast("int").alias("seq"), F.regexp_replace("raw", "[?#].*$", "").alias("href"))


class _Reader(HTMLParser):
    """Body text runs with the stack of open tags, comments and scripts left out. entities: what is decoded in texts, None for all of
    HTML's, in attributes too."""

    def __init__(self, entities: Mapping[str, str] | None = None) -> None:
        super().__init__(convert_charrefs=True)
        self.entities = entities
        # longer names first: `&amp;` is not `&amp` and a semicolon
        self.known = entities and re.compile("|".join(re.escape(x) for x in sorted(entities, key=len, reverse=True)))
        self.stack: list[str] = []
        self.rows: list[tuple[int, str, str, str]] = []
        self.inside = False

    def read(self, page: str) -> list[tuple[int, str, str, str]]:
        # with its ampersands escaped a page comes back from the parser as it was written
        self.feed(page if self.entities is None else page.replace("&", "&amp;"))
        self.close()
        return self.rows

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "body":
            self.inside = True
        key = ";".join(f"{k}={v or ''}" for k, v in sorted(dict(attrs).items()))
        if self.inside:
            self.rows.append((len(self.rows), "start", tag, key))
        if tag not in _VOID:
            self.stack.append(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in self.stack:
            while self.stack and self.stack.pop() != tag:
                pass
        if self.inside:
            self.rows.append((len(self.rows), "end", tag, ""))
        if tag == "body":
            self.inside = False

    def handle_data(self, data: str) -> None:
        if self.known:
            data = self.known.sub(lambda m: self.entities[m[0]], data)
        text = re.sub("[ \t\r\n]+", " ", data).strip(_SPACES)
        if self.inside and text and not {"script", "style"} & {*self.stack}:
            # AN13: the style key of a run: open inline tags, distinct and sorted
            self.rows.append((len(self.rows), "text", "+".join(sorted({*self.stack} - {"html", "body"})), text))


def html_events(pages: DataFrame, key: str, html: str, entities: Mapping[str, str] | None = None) -> DataFrame:
    """SC16/AN13: start, end and text events of each page's body: (key, seq, kind, name, value). name is the tag, or a text
    run's style key; value the sorted attributes, or the text.

    entities: those decoded in texts, as they are written (`&lt;`) and what they stand for; others and attributes stay as they are. Without it
    all that HTML knows are decoded, also those that it knows without a semicolon (`&quot` at the end of a cut text)."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            for k, x in zip(pdf["key"], pdf["html"], strict=True):
                out += [(k, *r) for r in _Reader(entities).read(x or "")]
            yield pd.DataFrame(out, columns=["key", "seq", "kind", "name", "value"])

    kind = pages.schema[key].dataType.simpleString()
    return dealt(pages.selectExpr(f"`{key}` AS key", f"`{html}` AS html"), "key", "html").mapInPandas(run, f"key {kind}, seq int, kind string, name string, value string").withColumnRenamed("key", key)


def note_pairs(events: DataFrame, key: str) -> DataFrame:
    """AN14: note markers (`href=#id`) and the bodies (`id=...`) they belong to; either may be missing."""
    marks = events.filter("kind = 'start'").withColumn("note", F.regexp_extract("value", "(?:^|;)href=#([^;]+)", 1)).filter("note <> ''").select(key, "note", F.col("seq").alias("mark_seq"))
    bodies = events.filter("kind = 'start'").withColumn("note", F.regexp_extract("value", "(?:^|;)id=([^;]+)", 1)).filter("note <> ''").select(key, "note", F.col("seq").alias("body_seq"))
    return marks.join(bodies, [key, "note"], "full_outer")
