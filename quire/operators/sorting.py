"""Sort keys as column lists, for orderBy and for windows, and small set aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def placed(df: DataFrame, by: Sequence[str], keys: Sequence[Column | str], name: str = "place") -> DataFrame:
    """A row's place in its group, from 1."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*keys)).cast("long"))


def by_count(count: str, *names: str) -> list[Column]:
    """ST4/ST12: the most frequent first, then by name."""
    return [F.desc(count), *map(F.col, names)]


def by_length(text: str, *names: str) -> list[Column]:
    """ST14: the longest first, then in the given order."""
    return [F.length(text).desc(), F.col(text), *map(F.col, names)]


def keyword_order(df: DataFrame, by: Sequence[str], name: str, number: Column, is_number: Column) -> tuple[DataFrame, list[Column]]:
    """ST6: by number where every key of a group is one, else by name. Returns df with a mark and the keys that use it."""
    marked = df.withColumn("all_numbers", F.bool_and(is_number).over(Window.partitionBy(*by)))
    return marked, [F.when(F.col("all_numbers"), number).otherwise(0), F.when(F.col("all_numbers"), "").otherwise(F.col(name))]


def canon_order(testament: Column, order: Column) -> list[Column]:
    """ST7/ST9/ST11: one part before the other, each in its own order."""
    return [testament.cast("int"), order]


def chosen(df: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """ST13: the first and the last publication of a set."""
    return df.groupBy(*by).agg(F.min(order).alias("first_pub"), F.max(order).alias("last_pub"))


def publication_report(df: DataFrame, pub: str, who: str, when: str) -> DataFrame:
    """AG14: rows, distinct members and the span of dates of each publication."""
    return df.groupBy(F.col(pub).alias("pub")).agg(F.count("*").alias("n_orders"), F.countDistinct(who).alias("n_customers"), F.min(when).alias("first_date"), F.max(when).alias("last_date"))


def joined(value: str, separator: str = " ") -> Column:
    """AG19: the distinct values of a group in order, joined."""
    return F.array_join(F.array_sort(F.collect_set(F.col(value).cast("string"))), separator)
