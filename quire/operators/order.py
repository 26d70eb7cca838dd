"""Document-order analytics: ordered scans over nodes within a key (see scan.py), and windows over keys that have a few rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.operators.scan import Scan, ordered


def _over(by: Sequence[str], order: Sequence[str]):  # noqa: ANN202
    return Window.partitionBy(*by).orderBy(*order)


def latest_preceding(df: DataFrame, value: Column, by: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """JN10: the last non-null value at or before each row (as-of in document order)."""
    return ordered(df, by, order, {name: Scan("last", value)})


def next_following(df: DataFrame, value: Column, by: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """JN11: the first non-null value after each row."""
    return ordered(df, by, order, {name: Scan("next", value)})


def sessions(df: DataFrame, starts: Column, by: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """WN7: numbers groups that begin where starts is true (group-starting-with); rows before the first start are group 0."""
    return ordered(df, by, order, {name: Scan("total", F.when(starts, 1).otherwise(0))})


def islands(df: DataFrame, value: str, by: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """WN7: numbers runs of equal values (group-adjacent)."""
    # a struct, so that a null before the row is told from no row before it
    seen = ordered(df, by, order, {f"__{name}": Scan("before", F.struct(F.col(value).alias("v")))})
    first = F.col(f"__{name}").isNull() | ~F.col(f"__{name}")["v"].eqNullSafe(F.col(value))
    return sessions(seen, first, by, order, name).drop(f"__{name}")


def ordinals(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """WN4: numbers rows in their section from 1."""
    return ordered(df, by, order, {name: Scan("number")}).withColumn(name, F.col(name).cast("int"))


def neighbours(df: DataFrame, value: str, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """WN6: prev_ and next_ value."""
    return ordered(df, by, order, {"prev_value": Scan("before", F.col(value)), "next_value": Scan("after", F.col(value))})


def heads(df: DataFrame, value: Column, by: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """WN8: whether a row's value differs from the one before (first of each letter)."""
    seen = ordered(df, by, order, {"__before": Scan("before", value)})
    return seen.withColumn(name, ~F.col("__before").eqNullSafe(value)).drop("__before")


def without_repeats(df: DataFrame, value: Column, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """WN11: drops rows that repeat the row before."""
    return heads(df, value, by, order, "__head").filter("__head").drop("__head")


def first_per_context(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """WN2, simple form: the first row of each (context, key)."""
    return df.withColumn("__n", F.row_number().over(_over(key, order))).filter("__n = 1").drop("__n")


def unique_ids(df: DataFrame, base: str, order: Sequence[str], name: str, taken: DataFrame | None = None) -> DataFrame:
    """WN5: base for the first row that has it, base.n for the n-th; numbers start behind those that `taken` (column id) uses."""
    out = df.withColumn("__n", F.row_number().over(_over([base], order)))
    if taken is not None:
        used = taken.select(F.regexp_extract("id", "^(.*?)(?:\\.(\\d+))?$", 1).alias(base), F.coalesce(F.expr("try_cast(regexp_extract(id, '^(.*?)(?:\\\\.(\\\\d+))?$', 2) AS int)"), F.lit(1)).alias("__u"))
        out = out.join(used.groupBy(base).agg(F.max("__u").alias("__u")), base, "left").withColumn("__n", F.col("__n") + F.coalesce("__u", F.lit(0))).drop("__u")
    return out.withColumn(name, F.when(F.col("__n") == 1, F.col(base)).otherwise(F.concat_ws(".", base, F.col("__n").cast("string")))).drop("__n")


def numbered_titles(df: DataFrame, title: str, by: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """WN10: a title that was there before gets ` (n)`."""
    n = F.row_number().over(_over([*by, title], order))
    return df.withColumn(name, F.when(n > 1, F.concat(F.col(title), F.lit(" ("), n.cast("string"), F.lit(")"))).otherwise(F.col(title)))


def layout(df: DataFrame, by: Sequence[str], order: Sequence[str], width: Column) -> DataFrame:
    """WN9: per row whether its place is odd, the section's number of rows and its largest width."""
    w = Window.partitionBy(*by)
    return df.withColumn("is_odd", F.row_number().over(_over(by, order)) % 2 == 1).withColumn("n_rows", F.count("*").over(w)).withColumn("max_width", F.max(width).over(w))


def sequence_findings(df: DataFrame, number: str, by: Sequence[str], order: Sequence[str], first: int = 1, last: Column | None = None) -> DataFrame:
    """WN1/DQ1: one finding for each break of a numbered sequence: missing (a gap), repeated or out of order; after a break
    the seen number is the expected one. last: the number that should end each group, for a finding `unfinished`."""
    seen = ordered(df, by, order, {"expected": Scan("before", F.col(number))}).withColumn("expected", F.coalesce(F.col("expected") + 1, F.lit(first)))
    kind = F.when(F.col(number) == F.col("expected"), None).when(F.col(number) > F.col("expected"), "missing").when(F.col(number) == F.col("expected") - 1, "repeated").otherwise("out of order")
    found = seen.withColumn("finding", kind).filter(F.col("finding").isNotNull()).select(*by, F.col("expected").cast("long").alias("expected"), F.col(number).cast("long").alias("seen"), "finding")
    if last is None:
        return found
    ends = df.groupBy(*by).agg(F.max(number).alias("top"), F.max(last).alias("due")).filter("top < due")
    return found.unionByName(ends.select(*by, (F.col("top") + 1).cast("long").alias("expected"), F.col("due").cast("long").alias("seen"), F.lit("unfinished").alias("finding")))


def repair_verses(df: DataFrame, by: Sequence[str], order: Sequence[str], start: str, end: str, due: Column) -> DataFrame:
    """WN13: a missing start follows the end before it, an end reaches to the next start, the last one to the canon's count.

    Adds fixed_start, fixed_end and corrected. Rows that the order does not tell apart are taken by their repaired start."""
    w = _over(by, order)
    a = F.coalesce(F.col(start), F.lag(end).over(w) + 1, F.lit(1))
    out = df.withColumn("fixed_start", a)
    following = F.lead("fixed_start").over(_over(by, [*order, "fixed_start"]))
    out = out.withColumn("fixed_end", F.when(following.isNull(), due).otherwise(F.greatest(F.col("fixed_start"), following - 1)))
    return out.withColumn("corrected", ~(F.col("fixed_start").eqNullSafe(F.col(start)) & F.col("fixed_end").eqNullSafe(F.col(end))))


def balance(df: DataFrame, opens: Column, closes: Column, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """WN1: open tags after each row; a negative number or one left at the end is an error."""
    step = F.when(opens, 1).when(closes, -1).otherwise(0)
    return ordered(df, by, order, {"open_tags": Scan("total", step)})


def before_first(df: DataFrame, mark: Column, by: Sequence[str], pre: str, name: str) -> DataFrame:
    """whether a row stands before the first marked row of its group (introductions before a book's first chapter)."""
    first = F.min(F.when(mark, F.col(pre))).over(Window.partitionBy(*by))
    return df.withColumn(name, F.coalesce(F.col(pre) < first, F.lit(False)))


def intro_hazards(df: DataFrame, section: Column, chapter: Column, by: Sequence[str], pre: str) -> DataFrame:
    """DQ5: section titles that stand before the first chapter of their group, where importers drop what follows them."""
    return before_first(df, chapter, by, pre, "__intro").filter(F.col("__intro") & section).drop("__intro")


def distinct_order(df: DataFrame, by: Sequence[str], value: str, name: str) -> DataFrame:
    """RD5 helper: the number of distinct values in a group, joined back (distinct counts are no window functions)."""
    return df.join(df.groupBy(*by).agg(F.countDistinct(value).alias(name)), [*by], "left")
