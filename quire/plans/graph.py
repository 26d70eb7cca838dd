"""Dependency closure, job levels and bounded collections."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def checkpoints(spark: SparkSession) -> None:
    """Without checkpoints a round's plan is twice as long as the one before. spark.checkpoint.dir names their folder; where it is
    unset, a local master gets a temporary one, and any other must be told."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="quire-"))


def closure(deps: DataFrame, job: str = "job", needs: str = "needs", rounds: int = 30) -> DataFrame:
    """AL1: every (job, needs) that follows from the direct ones, by doubling path lengths; cycles are allowed."""
    checkpoints(deps.sparkSession)
    paths = deps.select(job, needs).distinct().checkpoint()
    count = paths.count()
    for _ in range(rounds):
        step = paths.join(paths.select(F.col(job).alias(needs), F.col(needs).alias("__far")), needs).select(job, F.col("__far").alias(needs))
        paths = paths.unionByName(step).distinct().checkpoint()
        grown = paths.count()
        if grown == count:
            break
        count = grown
    return paths


def levels(deps: DataFrame, job: str = "job", needs: str = "needs") -> DataFrame:
    """AL2: (name, level, state) of all jobs. level: 0 without needs, otherwise one more than the highest level that it needs (jobs of a
    level can run together). Jobs that can never start have none: state `cycle` if they are on a cycle or between two, `blocked`
    if they wait for one; the others are `ready`.

    Each round takes the jobs without open needs and drops the needs that they meet, so a job is a row however many paths lead to
    it, and needs that are met are not read again. The number of rounds is the depth. Nulls count for nothing, repeated rows once."""
    checkpoints(deps.sparkSession)
    edges = deps.select(F.col(job).alias("name"), F.col(needs).alias("needs")).na.drop().distinct().checkpoint()
    names = deps.select(F.col(job).alias("name")).unionAll(deps.select(F.col(needs).alias("name"))).na.drop().distinct()
    last = names.join(edges.select("name").distinct(), "name", "left_anti").withColumn("level", F.lit(0)).checkpoint()
    done, level = last, 0
    by_name = Window.partitionBy("name")
    while True:
        level += 1
        met = last.select(F.col("name").alias("needs"), F.lit(1).alias("met"))
        marked = edges.join(met, "needs", "left").withColumn("open", F.count(F.when(F.col("met").isNull(), 1)).over(by_name))
        # jobs whose last open need is met, and the open needs of the others, in one table
        step = marked.filter("met IS NULL OR open = 0").select("name", "needs", F.when(F.col("open") == 0, level).alias("level")).checkpoint()
        last = step.filter("level IS NOT NULL").select("name", "level").distinct()
        edges = step.filter("level IS NULL").select("name", "needs")
        if not last.take(1):
            break
        done = done.unionAll(last)
        done = done.checkpoint() if level % 50 == 0 else done
    done = done.select("name", "level", F.lit("ready").alias("state"))
    if not edges.take(1):
        return done
    # what is left can't start; jobs that no job of these needs wait for a cycle only: peel them off from the other end
    core = edges
    while True:
        n = core.count()
        core = core.join(core.select(F.col("needs").alias("name")).distinct(), "name", "left_semi").checkpoint()
        if core.count() == n:
            break
    on = core.select("name").distinct().withColumn("state", F.lit("cycle"))
    rest = edges.select("name").distinct().join(on, "name", "left")
    return done.unionAll(rest.select("name", F.lit(None).cast("int").alias("level"), F.coalesce("state", F.lit("blocked")).alias("state")))


def bounded_collections(books: DataFrame, by: str, order: str, size: str, most: int, overhead: int = 0, book_overhead: int = 0) -> DataFrame:
    """AL4: while a collection is too large, its last book moves to the front of the next. Adds collection (from 1, in the books'
    order); a book that is too large stands alone, and books that the order does not tell apart come in any order.

    From running sums of the sizes each book knows how far a collection reaches that begins with it: to the last book whose sum is
    within the room behind it. The collections begin with the first book and wherever the one before ended, which pointer doubling
    finds: after k rounds a book knows the beginning 2**k collections further, and the beginnings among the first 2**k are known. A
    group may have any number of books: sums, reaches and pointers come from ordered scans and equi-joins."""
    from quire.operators.scan import Scan, ordered

    spark = books.sparkSession
    checkpoints(spark)
    cost, room = F.greatest(F.col(size).cast("long"), F.lit(0)) + book_overhead, most - overhead
    kept = [F.col(c) for c in books.columns]
    rows = books.select(F.struct(F.col(by)).alias("by_"), F.col(order).alias("order_"), cost.alias("cost_"), F.struct(*kept).alias("row_"), F.monotonically_increasing_id().alias("id_")).checkpoint()
    rows = ordered(rows, ["by_"], ["order_", "id_"], {"n_": Scan("number"), "sum_": Scan("total", F.col("cost_"))}).checkpoint()
    # a merged order of all sums and all reaches: what a reach stands behind is the last book that it covers
    sums = rows.select("by_", F.col("sum_").alias("at_"), F.lit(0).alias("kind_"), F.col("n_").alias("book_"))
    reach = rows.select("by_", (F.col("sum_") - F.col("cost_") + room).alias("at_"), F.lit(1).alias("kind_"), F.col("n_").alias("book_"))
    merged = ordered(sums.unionAll(reach), ["by_"], ["at_", "kind_", "book_"], {"last_": Scan("last", F.when(F.col("kind_") == 0, F.col("book_")))})
    # a book that is too large alone covers itself
    jump = merged.filter("kind_ = 1").select("by_", F.col("book_").alias("n_"), (F.greatest("last_", "book_") + 1).alias("to_")).checkpoint()
    begins = rows.filter("n_ = 1").select("by_", "n_", F.lit(1).cast("long").alias("collection")).checkpoint()
    most_books = rows.agg(F.max("n_")).first()[0] or 0
    step = 1
    while step < most_books:
        # beginnings reached so far, and those `step` collections further
        further = begins.join(jump, ["by_", "n_"]).select("by_", F.col("to_").alias("n_"), (F.col("collection") + step).alias("collection"))
        further = further.join(rows.select("by_", "n_"), ["by_", "n_"], "left_semi")
        grown = begins.unionAll(further).checkpoint()
        if grown.count() == begins.count():
            break
        begins, step = grown, step * 2
        jump = jump.join(jump.select("by_", F.col("n_").alias("to_"), F.col("to_").alias("far_")), ["by_", "to_"]).select("by_", "n_", F.col("far_").alias("to_")).checkpoint()
    marked = rows.join(begins, ["by_", "n_"], "left")
    out = ordered(marked, ["by_"], ["n_"], {"collection": Scan("last", F.col("collection"))})
    return out.select("row_.*", F.col("collection").cast("int").alias("collection"))


def dealt(df: DataFrame, *by: str) -> DataFrame:
    """df dealt over tasks by columns' hashes, for what costs far more than the exchange: a packed file of many small rows may come as
    one task. Adaptive execution leaves this number of tasks as it is."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism), *by)


def batches(df: DataFrame, by: list[str], order: list[str], rows: int) -> DataFrame:
    """SK9: numbers batches of so many rows within a partition key, for writing with partitionBy("batch")."""
    return df.withColumn("batch", F.floor((F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1) / rows).cast("long"))


def jobs_to_run(jobs: DataFrame, keep: str | None, skip: str | None, unsupported: DataFrame | None = None) -> DataFrame:
    """jobs whose module matches keep and not skip, unsupported (script, kind) pairs left out."""
    if keep:
        jobs = jobs.filter(F.col("module").rlike(keep))
    if skip:
        jobs = jobs.filter(~F.col("module").rlike(skip))
    return jobs.join(unsupported, ["script", "kind"], "left_anti") if unsupported is not None else jobs
