"""Configuration files: sections, includes, continuation lines, deletions and repeated entries."""

from __future__ import annotations

import posixpath
import re
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "section string, entry string, seq int, value string, src_file string"
_LINE = re.compile(r"^\s*([^=#\[\]\s][^=]*?)\s*=\s*(.*?)\s*$")


def parse(name: str, read: Callable[[str], str], multiple: Iterable[str] = (), depth: int = 0) -> list[tuple[str, str, int, str | None, str]]:
    """SC10/AL3: entries in file order. `Include:path` reads another file in place, relative to this one; a line that ends
    in a backslash goes on; the value `undef` is null, a deletion. multiple: entries that may repeat."""
    if depth > 16:
        raise ValueError(f"includes nest too deeply at {name}")
    rows: list[tuple[str, str, int, str | None, str]] = []
    section, many, text = "MAIN", set(multiple), re.sub(r"\\\n", "\n\\\\", read(name))
    joined: list[str] = []
    for line in text.split("\n"):
        if line.startswith("\\") and joined:
            joined[-1] += "\n" + line.lstrip("\\").lstrip()
        else:
            joined.append(line)
    for line in joined:
        if m := re.match(r"^\s*\[(.+?)\]\s*$", line.split("\n")[0]):
            section = m[1]
        elif m := re.match(r"^\s*Include:\s*(\S+)\s*$", line):
            rows += parse(posixpath.join(posixpath.dirname(name), m[1]), read, multiple, depth + 1)
        elif m := _LINE.match(line.split("\n")[0]):
            value = "\n".join([m[2], *line.split("\n")[1:]])
            seq = sum(r[0] == section and r[1] == m[1] for r in rows) if m[1] in many else 0
            rows.append((section, m[1], seq, None if value == "undef" else value, name))
    return rows


def read(spark: SparkSession, path: str, multiple: Iterable[str] = ()) -> DataFrame:
    """conf(section, entry, seq, value, src_file) of a file and its includes; small by nature, parsed on the driver."""

    def text(p: str) -> str:
        return "\n".join(r.value for r in spark.read.text(p).collect())

    return settle(spark.createDataFrame([(*r, i) for i, r in enumerate(parse(path, text, multiple))], SCHEMA + ", line int"))


def settle(rows: DataFrame) -> DataFrame:
    """Later values win, `undef` (null) deletes what was there before."""
    last = rows.groupBy("section", "entry", "seq").agg(F.max_by(F.struct("value", "src_file"), "line").alias("x"))
    return last.select("section", "entry", "seq", "x.value", "x.src_file").filter("value IS NOT NULL")


def text_of(conf: DataFrame, defaults: DataFrame | None = None) -> DataFrame:
    """SK2: the file's lines in section, then entry order; values that the defaults have too are left out if these are given."""
    out = conf.select("section", "entry", "seq", "value")
    if defaults is not None:
        out = out.exceptAll(defaults.select("section", "entry", "seq", "value"))
    body = out.groupBy("section").agg(F.array_sort(F.collect_list(F.struct("entry", "seq", "value"))).alias("x"))
    return body.select("section", F.concat(F.lit("["), F.col("section"), F.lit("]\n"), F.array_join(F.transform("x", lambda e: F.concat(e["entry"], F.lit("="), F.replace(e["value"], F.lit("\n"), F.lit("\\\n")))), "\n")).alias("text"))


def default_file(files: DataFrame, name: str = "name") -> DataFrame:
    """SC18: of files (name, path, priority) the one in the directory that comes first; of several there the one with the smallest
    path. Files without a path or a priority are none."""
    first = F.when(F.col("priority").isNotNull() & F.col("path").isNotNull(), F.struct("priority", "path"))
    return files.groupBy(name).agg(F.min(first)["path"].alias("path"))


def with_defaults(settings: DataFrame, defaults: DataFrame) -> DataFrame:
    """SC14: default settings (key, value) overlaid by a file's."""
    return defaults.withColumnRenamed("value", "__d").join(settings, "key", "full_outer").select("key", F.coalesce("value", "__d").alias("value"))


def differences(conf: DataFrame, defaults: DataFrame) -> DataFrame:
    """RG12: entries whose value is not the default's, and those that only one side has."""
    a, b = conf.withColumnRenamed("value", "project_value"), defaults.withColumnRenamed("value", "default_value")
    both = a.join(b, ["section", "entry", "seq"], "full_outer")
    return both.filter(~F.col("project_value").eqNullSafe(F.col("default_value"))).select("section", "entry", "seq", "project_value", "default_value")
