"""XML documents to node tables and back, and file probes.

Spark's XML reader loses the order of text and elements in mixed content, so documents are shredded by a pull parser.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from xml.parsers import expat
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NODE = "work string, pre int, post int, parent int, depth int, kind string, name string, attrs map<string,string>, text string"


def _walk(work: str, xml: str) -> Iterator[tuple]:
    """The nodes of a document, elements when they end. The open elements are a list, so that depth costs no calls."""
    done: list[tuple] = []
    open_: list[list] = []
    said: list[str] = []
    number = 0

    def flush() -> None:
        nonlocal number
        if said and open_:
            done.append((work, number, number, open_[-1][1], len(open_), "text", None, None, "".join(said)))
            number += 1
        said.clear()

    def start(name: str, attrs: dict[str, str]) -> None:
        nonlocal number
        flush()
        open_.append([work, number, open_[-1][1] if open_ else None, len(open_), name.rpartition("}")[2], {k.rpartition("}")[2]: v for k, v in attrs.items()}])
        number += 1

    def end(name: str) -> None:
        flush()
        _, at, parent, depth, own, attrs = open_.pop()
        done.append((work, at, number - 1, parent, depth, "element", own, attrs, None))

    parser = expat.ParserCreate(namespace_separator="}")
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, said.append
    for i in range(0, len(xml), 2**20):
        parser.Parse(xml[i : i + 2**20], False)
    parser.Parse("", True)
    return iter(done)


def shred(docs: DataFrame, key: str, xml: str) -> DataFrame:
    """SC5/D2: elements and texts in document order. pre numbers them from 0, post is the last pre within a node.
    A document that is not well-formed gives one row of kind `error`."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out: list[tuple] = []
            for work, x in zip(pdf["work"], pdf["xml"], strict=True):
                try:
                    out += _walk(work, x or "")
                except (expat.ExpatError, UnicodeEncodeError) as e:
                    out.append((work, 0, 0, None, 0, "error", None, None, str(e)))
            yield pd.DataFrame(out, columns=["work", "pre", "post", "parent", "depth", "kind", "name", "attrs", "text"]).astype({"parent": "Int32"})

    return docs.select(F.col(key).cast("string").alias("work"), F.col(xml).alias("xml")).mapInPandas(run, NODE)


def serialise(nodes: DataFrame) -> DataFrame:
    """SK1: (work, xml) from a node table; nodes are put in order within their work."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        parts: list[str] = []
        open_: list[tuple[int, str]] = []
        for r in pdf.sort_values("pre").itertuples():
            while open_ and r.pre > open_[-1][0]:
                parts.append(f"</{open_.pop()[1]}>")
            if r.kind == "text":
                parts.append(escape(r.text))
                continue
            attrs = "".join(f" {k}={quoteattr(v)}" for k, v in sorted((r.attrs or {}).items()))
            if r.post == r.pre:
                parts.append(f"<{r.name}{attrs}/>")
            else:
                parts.append(f"<{r.name}{attrs}>")
                open_.append((r.post, r.name))
        parts += [f"</{n}>" for _, n in reversed(open_)]
        return pd.DataFrame({"work": [pdf["work"].iloc[0]], "xml": ["".join(parts)]})

    return nodes.filter("kind <> 'error'").groupBy("work").applyInPandas(run, "work string, xml string")


def image_probe(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """SC19: format, width, height and size of image bytes (PNG, GIF, JPEG); nulls for anything else."""

    def probe(b: bytes) -> tuple[str | None, int | None, int | None]:
        if b[:8] == b"\x89PNG\r\n\x1a\n" and len(b) >= 24:
            return ("png", *struct.unpack(">II", b[16:24]))
        if b[:6] in (b"GIF87a", b"GIF89a") and len(b) >= 10:
            return ("gif", *struct.unpack("<HH", b[6:10]))
        if b[:2] == b"\xff\xd8":
            at = 2
            while at + 9 < len(b) and b[at] == 0xFF:
                if 0xC0 <= b[at + 1] <= 0xCF and b[at + 1] not in (0xC4, 0xC8, 0xCC):
                    h, w = struct.unpack(">HH", b[at + 5 : at + 9])
                    return "jpeg", w, h
                at += 2 + struct.unpack(">H", b[at + 2 : at + 4])[0]
        return None, None, None

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            got = [probe(bytes(c) if c is not None else b"") for c in pdf["content"]]
            yield pd.DataFrame({"path": pdf["path"], "format": [g[0] for g in got], "w": pd.array([g[1] for g in got], "Int32"), "h": pd.array([g[2] for g in got], "Int32"), "size": [len(c) if c is not None else 0 for c in pdf["content"]]})

    return files.select(F.col(path).alias("path"), F.col(content).alias("content")).mapInPandas(run, "path string, format string, w int, h int, size long")
