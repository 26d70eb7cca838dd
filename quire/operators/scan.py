"""Ordered scans: what a window over a whole group says of its rows, also where one group holds a large share of all rows.

A window takes a group to one task. Here the rows of large groups are dealt over ranges of (group, order), each range says in one
row what it passes on (its last value, its sum, ...), these rows are scanned, and what comes before a range is joined back to its
rows. Groups of ROWS rows at most take the plain window, whose task has a bound then.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.plans.graph import checkpoints

#: Rows of a group that one task orders, and of a range on average; large groups at most (with more, a group must be larger to count).
ROWS, GROUPS = 2**20, 100_000


@dataclass(frozen=True)
class Scan:
    """What a row gets. value: a column of the row. what: `last` (the last value that is not null, up to the row), `before` (the
    value of the row before), `next` (the first value that is not null, behind the row), `after` (the value of the row behind),
    `total` (the sum of the values up to the row; null until there is one) or `number` (of rows up to the row)."""

    what: str
    value: Column | None = None


def _window(scan: Scan, value: Column, by: Sequence[str], order: Sequence[Column]) -> Column:
    w = Window.partitionBy(*by).orderBy(*order)
    past, future = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(1, Window.unboundedFollowing)
    return {
        "last": lambda: F.last(value, ignorenulls=True).over(past),
        "before": lambda: F.lag(value).over(w),
        "next": lambda: F.first(value, ignorenulls=True).over(future),
        "after": lambda: F.lead(value).over(w),
        "total": lambda: F.sum(value).over(past),
        "number": lambda: F.row_number().over(w).cast("long"),
    }[scan.what]()


def ordered(df: DataFrame, by: Sequence[str], order: Sequence[str], scans: Mapping[str, Scan]) -> DataFrame:
    """df with a column for each scan, over the rows of its group (by, null is a group too) in their order. Another column of df that
    is called as a scan is replaced; values are of the row before that. Rows that the order does not tell apart come in any order, as
    in a window. Groups are counted first; if none is large, the rest is one lazy window."""
    spark, tag = df.sparkSession, f"__{uuid.uuid4().hex[:8]}"
    group, part, row = f"{tag}group", f"{tag}part", f"{tag}row"
    rest = [c for c in df.columns if c not in scans]
    values = {name: f"{tag}{i}" for i, name in enumerate(scans)}
    keys = [F.col(c) for c in order]
    # a struct as the key: two of them are equal also where they hold nulls, in windows and joins alike
    rows = df.select(*rest, F.struct(F.lit(0), *by).alias(group), *((s.value if s.value is not None else F.lit(1)).alias(values[n]) for n, s in scans.items()))
    plain = lambda part: part.select(*rest, *(_window(s, F.col(values[n]), [group], keys).alias(n) for n, s in scans.items()))
    counts = rows.groupBy(group).count()
    total = counts.agg(F.sum("count").alias("n"), F.max("count").alias("most")).first()
    limit = max(ROWS, (total.n or 0) // GROUPS)
    if (total.most or 0) <= limit:
        return plain(rows)
    checkpoints(spark)
    found = counts.filter(F.col("count") > limit).collect()  # GROUPS rows at most
    marks, many = spark.createDataFrame(found, counts.schema), sum(r["count"] for r in found)
    small, heavy = plain(rows.join(marks, group, "left_anti")), rows.join(marks.select(group), group, "left_semi")
    # the row number parts rows that the order does not tell apart; a written table, since ranges are sampled anew each time
    heavy = heavy.withColumn(row, F.monotonically_increasing_id()).repartitionByRange(-(-many // ROWS) * 2, group, *keys, row)
    heavy = heavy.withColumn(part, F.spark_partition_id()).checkpoint()
    inner, line = [group, part], [*keys, F.col(row)]
    local = heavy.select("*", *(_window(s, F.col(values[n]), inner, line).alias(n) for n, s in scans.items()))
    edge = Window.partitionBy(*inner).orderBy(*line)
    local = local.withColumn(f"{tag}first", F.lag(F.lit(1)).over(edge).isNull()).withColumn(f"{tag}last", F.lead(F.lit(1)).over(edge).isNull())
    place = F.struct(*order, row)
    passed = {
        "last": lambda v: F.max_by(v, F.when(v.isNotNull(), place)),
        "before": lambda v: F.max_by(F.struct(v.alias("v")), place),
        "next": lambda v: F.min_by(v, F.when(v.isNotNull(), place)),
        "after": lambda v: F.min_by(F.struct(v.alias("v")), place),
        "total": F.sum,
        "number": lambda v: F.count("*"),
    }
    said = heavy.groupBy(*inner).agg(*(passed[s.what](F.col(values[n])).alias(f"{values[n]}s") for n, s in scans.items()))
    w = Window.partitionBy(group).orderBy(part)  # a row for each range of the group
    past, future = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    carried = {
        "last": lambda v: F.last(v, ignorenulls=True).over(past),
        "before": lambda v: F.lag(v).over(w),
        "next": lambda v: F.first(v, ignorenulls=True).over(future),
        "after": lambda v: F.lead(v).over(w),
        "total": lambda v: F.sum(v).over(past),
        "number": lambda v: F.sum(v).over(past),
    }
    carry = said.select(*inner, *(carried[s.what](F.col(f"{values[n]}s")).alias(f"{values[n]}c") for n, s in scans.items()))

    def whole(name: str, s: Scan) -> Column:
        here, there = F.col(name), F.col(f"{values[name]}c")
        if s.what in ("last", "next"):
            return F.coalesce(here, there)
        if s.what in ("before", "after"):
            return F.when(F.col(f"{tag}{'first' if s.what == 'before' else 'last'}"), there["v"]).otherwise(here)
        if s.what == "total":
            return F.coalesce(here + there, here, there)
        return here + F.coalesce(there, F.lit(0))

    joined = local.join(carry, inner)
    done = joined.select(*rest, *(whole(n, s).cast(local.schema[n].dataType).alias(n) for n, s in scans.items()))
    return small.unionByName(done)
