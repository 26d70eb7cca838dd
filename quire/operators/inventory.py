"""Corpus inventories and statistics."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import code_points

RARE = 20


def char_inventory(df: DataFrame, text: str) -> DataFrame:
    """AG1: each code point with its count and whether it is rare. Counted on the map side, so little is shuffled."""
    chars = df.select(F.explode(code_points(F.col(text))).alias("ch"))
    return chars.groupBy("ch").agg(F.count("*").alias("n")).withColumn("is_rare", F.col("n") < RARE)


def cluster_inventory(df: DataFrame, text: str) -> DataFrame:
    """AG1: extended grapheme clusters of more than one code point, with counts. Spark has no \\X, so batches are counted in Python."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        for batch in batches:
            seen: Counter = Counter()
            for x in batch.column(0):
                seen.update(c for c in regex.findall(r"\X", x.as_py() or "") if len(c) > 1)
            yield pa.RecordBatch.from_arrays([pa.array([*seen], pa.string()), pa.array([*seen.values()], pa.int64())], ["cluster", "n"])

    return df.select(text).mapInArrow(run, "cluster string, n bigint").groupBy("cluster").agg(F.sum("n").alias("n"))


def high_chars(df: DataFrame, key: str, text: str, above: int, keep: int = 5) -> DataFrame:
    """AG2: characters above a code point with their first occurrences (keep at most: it is the report's length)."""
    high = f"[^\\x{{0}}-\\x{{{above:X}}}]"
    rows = df.filter(F.col(text).rlike(high)).select(key, F.posexplode(code_points(F.col(text))).alias("pos", "ch")).filter(F.col("ch").rlike(high))
    w = Window.partitionBy("ch").orderBy(key, "pos")
    return rows.withColumn("nth", F.row_number().over(w)).filter(F.col("nth") <= keep).select("ch", F.col("nth").cast("int").alias("nth"), key, (F.col("pos") + 1).cast("int").alias("pos"))


def reference_counts(annotations: DataFrame, kind: str) -> DataFrame:
    """AG3: annotations of each type and in total (kind null)."""
    return annotations.rollup(kind).agg(F.count("*").alias("n"))


def link_report(df: DataFrame, target: str, text: str, context: str) -> DataFrame:
    """AG4: counts for each target, each (target, text) and each (target, context) by grouping sets."""
    return df.groupingSets([[target], [target, text], [target, context]], target, text, context).agg(F.count("*").alias("n"))


def unused(rules: DataFrame, hits: DataFrame, key: str) -> DataFrame:
    """AG5: rules that no hit names."""
    return rules.join(hits.select(key).distinct(), key, "left_anti")


def merge_metrics(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """AG6/UX7: partial results put together: numbers (n) add up, texts (said) are concatenated in order (seq), lists (items) appended."""
    ordered = F.array_sort(F.collect_list(F.struct("seq", "said", "items")))
    return parts.groupBy(*by).agg(F.sum("n").alias("n"), ordered.alias("p")).select(*by, "n", F.array_join(F.transform("p", lambda x: x["said"]), "").alias("said"), F.flatten(F.transform("p", lambda x: x["items"])).alias("items"))


def extents(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """AG11: smallest and largest number of each group."""
    return df.groupBy(*by).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))


def shares(df: DataFrame, by: str, size: Column) -> DataFrame:
    """AG12: each group's size and its share of the whole. The whole is one number, summed from the groups."""
    each = df.groupBy(by).agg(F.sum(size).alias("size"))
    return each.crossJoin(F.broadcast(each.agg(F.sum("size").alias("whole")))).select(by, "size", (F.col("size") / F.col("whole")).alias("share"))


def largest_group(df: DataFrame, by: str) -> DataFrame:
    """AG13: number of rows of each group, and whether it is the largest (ties: the smallest name)."""
    each = df.groupBy(by).agg(F.count("*").alias("n"))
    top = each.agg(F.max_by(by, F.struct("n", F.lit(0))).alias("__x"), F.max("n").alias("__n"))
    names = each.join(F.broadcast(top), F.col("n") == F.col("__n"), "left_semi").agg(F.min(by).alias("__top"))
    return each.crossJoin(F.broadcast(names)).select(by, "n", (F.col(by) == F.col("__top")).alias("is_largest"))


def distinct_numbers(df: DataFrame, text: str, pattern: str) -> DataFrame:
    """AG15: the distinct matches of a pattern (ISBN, say) and the rows that have them."""
    found = df.select(F.explode(F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)))).alias("match"))
    return found.groupBy("match").agg(F.count("*").alias("n_rows"))


def shortest_names(df: DataFrame, by: str, name: str, preferred: str) -> DataFrame:
    """AG16/SC13: each group's shortest name; of equally short ones a preferred, then the smallest."""
    return df.groupBy(by).agg(F.min_by(name, F.struct(F.length(name), (~F.col(preferred)).cast("int"), F.col(name))).alias("short_name"), F.max_by(name, F.struct(F.length(name), F.col(name))).alias("long_name"))


def smaller_side(df: DataFrame, by: str, member: str, keep: Column) -> DataFrame:
    """AG17: members split by a condition; the smaller list is written, as `context` if that is the kept one, else `notContext`."""
    kept, left = F.sum(keep.cast("long")), F.sum((~keep).cast("long"))
    listed = lambda c: F.array_join(F.array_sort(F.collect_set(F.when(c, F.col(member)))), " ")
    g = df.groupBy(by).agg(kept.alias("n_kept"), left.alias("n_left"), listed(keep).alias("k"), listed(~keep).alias("l"))
    return g.select(by, F.when(F.col("n_left") == 0, "all").when(F.col("n_kept") < F.col("n_left"), "context").otherwise("notContext").alias("side"), F.when(F.col("n_left") == 0, "").when(F.col("n_kept") < F.col("n_left"), F.col("k")).otherwise(F.col("l")).alias("members"))


def tag_inventory(pages: DataFrame, html: str) -> DataFrame:
    """AG18: start and end tags with counts."""
    found = F.regexp_extract_all(F.col(html), F.lit("<(/?[A-Za-z][A-Za-z0-9]*)"), F.lit(1))
    return pages.select(F.explode(F.transform(found, F.lower)).alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))


def class_inventory(pages: DataFrame, html: str) -> DataFrame:
    """AG18/AN22: tag and class pairs with counts, the table that a user maps to meanings."""
    tags = F.regexp_extract_all(F.col(html), F.lit('<([A-Za-z][A-Za-z0-9]*)[^>]*?\\sclass="([^"]*)"'), F.lit(1))
    classes = F.regexp_extract_all(F.col(html), F.lit('<([A-Za-z][A-Za-z0-9]*)[^>]*?\\sclass="([^"]*)"'), F.lit(2))
    return pages.select(F.explode(F.arrays_zip(tags.alias("tag"), classes.alias("cls"))).alias("x")).groupBy(F.lower("x.tag").alias("tag"), F.col("x.cls").alias("class")).agg(F.count("*").alias("n"))


def style_findings(inventory: DataFrame, mapping: DataFrame) -> DataFrame:
    """AN22: classes without a meaning and meanings without a class."""
    a = inventory.join(mapping, ["tag", "class"], "left_anti").select("tag", "class", F.lit("unmapped").alias("finding"))
    return a.unionByName(mapping.join(inventory, ["tag", "class"], "left_anti").select("tag", "class", F.lit("unused").alias("finding")))
