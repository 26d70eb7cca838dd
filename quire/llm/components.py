"""Connected components by alternating large-star and small-star rounds over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import cut, discard


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star round. edges (a, b) with a > b. The minima are cut first, so that the join that hands them out has plain
    exchanges on both sides and adaptive execution can split a hub."""
    if large:
        sides = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        sides = edges
    least = cut(sides.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
    met = sides.join(least, "a")
    if large:
        out = met.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = met.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select("a", F.col("m").alias("b")))
    done = cut(out.distinct(), "star")
    discard(least)
    return done


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge; root is the smallest node that it reaches.

    edges: two columns of one orderable type, any orientation, repeats and self-loops allowed (a node with only a
    self-loop, or with a null partner, has no row). The rounds stop when every node points at its root; their number
    grows with the logarithm of the nodes. No more than one row per edge lives in any round.
    """
    x, y = edges.columns
    now = cut(edges.filter(F.col(x) != F.col(y)).select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct(), "edges")
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))).first()
        if mark == seen or mark[0] == 0:
            break
        seen = mark
        wide = _star(now, large=True)
        discard(now)
        now = _star(wide, large=False)
        discard(wide)
    roots = now.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)
