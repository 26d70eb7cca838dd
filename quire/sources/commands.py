"""Marked-up sources and command files as line tables.

A line table has (path, line_no, raw). Spark numbers lines within a whole-text read, so order does not depend on splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, paths: str | Sequence[str], recursive: bool = False) -> DataFrame:
    """SC1/SC2: files as lines. A file is read whole, so one file should fit a task."""
    reader = spark.read.option("wholetext", True).option("recursiveFileLookup", recursive)
    whole = reader.text(paths if isinstance(paths, str) else [*paths]).select(F.col("_metadata.file_path").alias("path"), "value")
    return lines_of(whole, "path", "value")


def lines_of(df: DataFrame, key: str, text: str) -> DataFrame:
    """Texts as lines: key, line_no (from 1), raw. The empty line behind a last line feed is left out."""
    rows = df.select(F.col(key), F.posexplode(F.split(F.col(text), "\r\n|\r|\n")).alias("pos", "raw"), F.size(F.split(F.col(text), "\r\n|\r|\n")).alias("__n"))
    return rows.filter((F.col("raw") != "") | (F.col("pos") + 1 < F.col("__n"))).select(key, (F.col("pos") + 1).alias("line_no"), "raw")


def run_files(files: DataFrame, runs: DataFrame) -> DataFrame:
    """SC1: files of RUN lines (seq, glob) in the listed order; a file listed twice comes twice. files: path."""
    like = F.regexp_replace(F.regexp_replace(F.regexp_replace("glob", "\\.", "\\\\."), "\\*", "[^/]*"), "\\?", "[^/]")
    return files.crossJoin(runs).filter(F.expr("path").rlike(F.concat(F.lit("(^|/)"), like, F.lit("$")))).select("seq", "path")


def markers(lines: DataFrame, key: str) -> DataFrame:
    """SC4/FX1: backslash markers of each line in order: key, line_no, seq, marker, is_end, text, attrs (the part behind a bar)."""
    shape = "\\\\(\\+?[A-Za-z]+\\d*)(\\*?)([^\\\\]*)"
    get = lambda g: F.regexp_extract_all("raw", F.lit(shape), F.lit(g))
    zipped = F.arrays_zip(get(1).alias("marker"), get(2).alias("star"), get(3).alias("body"))
    rows = lines.select(key, "line_no", F.posexplode(zipped).alias("seq", "x"))
    return rows.select(key, "line_no", "seq", F.col("x.marker").alias("marker"), (F.col("x.star") == "*").alias("is_end"), F.trim(F.substring_index("x.body", "|", 1)).alias("text"), F.when(F.instr("x.body", "|") > 0, F.trim(F.substring_index("x.body", "|", -1))).alias("attrs"))


def file_facts(marks: DataFrame, key: str, wanted: Sequence[str] = ("id", "h", "mt", "toc1", "toc2", "toc3", "periph"), stops: Sequence[str] = ("c", "ie")) -> DataFrame:
    """SC2: the first text of each wanted marker before the first stop marker of its file."""
    place = F.struct("line_no", "seq")
    stop = marks.filter(F.col("marker").isin(*stops)).groupBy(key).agg(F.min(place).alias("stop"))
    head = marks.filter(F.col("marker").isin(*wanted)).join(stop, key, "left").filter(F.col("stop").isNull() | (place < F.col("stop")))
    return head.groupBy(key).pivot("marker", [*wanted]).agg(F.min_by("text", place))


def classify(facts: DataFrame, books: DataFrame) -> DataFrame:
    """SC3: a file's type from its \\id: a known book is `bible`, GLO/DIC... a dictionary, CB a children's book, else other."""
    code = F.upper(F.substring(F.col("id"), 1, 3))
    known = books.select(F.upper("code").alias("__c")).distinct().withColumn("__known", F.lit(True))
    out = facts.withColumn("__code", code).join(known, F.col("__code") == F.col("__c"), "left")
    kind = F.when(F.col("__known"), "bible").when(F.col("__code").isin("GLO", "DIC", "CNC", "NDX"), "dictionary").when(F.upper("id").rlike("CHILD|^CB"), "childrens").otherwise("other")
    return out.withColumn("kind", kind).drop("__code", "__c", "__known")


def commands(lines: DataFrame, key: str) -> DataFrame:
    """SC6/SC7: `COMMAND(label):value` lines; comments and empty lines are left out, other lines have command `?`."""
    code = lines.filter(~F.col("raw").rlike("^\\s*(#.*)?$"))
    shape = "^\\s*([A-Z][A-Z0-9_ ]*?)\\s*(?:\\(([^)]*)\\))?\\s*:\\s*(.*?)\\s*$"
    get = lambda g: F.regexp_extract("raw", shape, g)
    name = F.when(get(1) == "", "?").otherwise(get(1))
    return code.select(key, "line_no", name.alias("command"), F.nullif(get(2), F.lit("")).alias("label"), F.when(get(1) == "", F.trim("raw")).otherwise(get(3)).alias("value"))


def rules_in_force(cmds: DataFrame, key: str, rule: str = "EVAL_REGEX", run: str = "RUN") -> DataFrame:
    """SC8: which rules hold for which RUN line. A rule holds for later RUN lines until an empty rule of its label.

    A rule's validity is an interval of lines, joined to the RUN lines in it: (key, run_line, run_value, rule_line, label, rule_value)."""
    r = cmds.filter(F.col("command") == rule).withColumn("label", F.coalesce("label", F.lit("")))
    ends = F.first(F.when(F.col("value") == "", F.col("line_no")), ignorenulls=True).over(Window.partitionBy(key, "label").orderBy("line_no").rowsBetween(1, Window.unboundedFollowing))
    spans = r.withColumn("until", ends).filter("value <> ''").select(key, F.col("line_no").alias("rule_line"), "label", F.col("value").alias("rule_value"), "until")
    runs = cmds.filter(F.col("command") == run).select(key, F.col("line_no").alias("run_line"), F.col("value").alias("run_value"))
    return runs.join(spans, key).filter((F.col("rule_line") < F.col("run_line")) & (F.col("until").isNull() | (F.col("run_line") < F.col("until")))).drop("until")


def with_mode(cmds: DataFrame, key: str, mode: str = "MODE") -> DataFrame:
    """SC9: each command with the mode set last before it."""
    w = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    return cmds.withColumn("mode", F.last(F.when(F.col("command") == mode, F.col("value")), ignorenulls=True).over(w)).filter(F.col("command") != mode)


def change_table(lines: DataFrame, key: str) -> DataFrame:
    """SC22: `"old" > "new"` lines in their order, quotes of either kind, comments behind `c `."""
    shape = "^\\s*(?:\"([^\"]*)\"|'([^']*)')\\s*>\\s*(?:\"([^\"]*)\"|'([^']*)')"
    pick = lambda a, b: F.when(F.regexp_extract("raw", shape, a) != "", F.regexp_extract("raw", shape, a)).otherwise(F.regexp_extract("raw", shape, b))
    return lines.filter(F.col("raw").rlike(shape)).select(key, "line_no", pick(1, 2).alias("old"), pick(3, 4).alias("new"))


def replacement_chars(rows: DataFrame, old: str, new: str) -> DataFrame:
    """SC21: aligned strings as (seq, old, new) characters."""
    z = F.arrays_zip(F.filter(F.split(old, ""), lambda c: c != "").alias("old"), F.filter(F.split(new, ""), lambda c: c != "").alias("new"))
    return rows.select(F.posexplode(z).alias("seq", "x")).select("seq", "x.old", "x.new").filter("old IS NOT NULL AND new IS NOT NULL")


def with_preamble(lines: DataFrame, key: str, header: Column) -> tuple[DataFrame, DataFrame]:
    """SC11/D16: a table file with settings before its header row: (settings lines, data lines with their header)."""
    at = lines.filter(header).groupBy(key).agg(F.min("line_no").alias("__h"), F.min_by("raw", "line_no").alias("header"))
    all_ = lines.join(at, key)
    return all_.filter("line_no < __h").drop("__h", "header"), all_.filter("line_no > __h").drop("__h")


def findings_from_log(lines: DataFrame, key: str) -> DataFrame:
    """SC12/D15: ERROR, WARNING, NOTE and REPORT lines of a log as findings."""
    shape = "^\\S*\\s*(ERROR|WARNING|NOTE|REPORT):\\s*(.*)$"
    return lines.filter(F.col("raw").rlike(shape)).select(key, "line_no", F.regexp_extract("raw", shape, 1).alias("severity"), F.regexp_extract("raw", shape, 2).alias("message"))
