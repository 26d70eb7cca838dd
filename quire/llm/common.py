"""What the corpus operators share: tables cut into the shared folder, and small DataFrame helpers."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: The tables cut within each open scratch, innermost last.
_SCRATCH: list[list[DataFrame]] = []
#: Stands for a null doc_id inside an operator: null sorts before every other id.
NULL_ID = -(2**63)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a temporary one serves a local master;
    any other is refused, as its executors would each write to a disk of their own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = getattr(spark, "_quire_scratch", None)
        if folder is None:
            folder = spark._quire_scratch = "file://" + tempfile.mkdtemp(prefix="quire-")
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/quire-{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: the lineage ends here and a lost executor costs no rerun."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._quire_path = path
    if _SCRATCH:
        _SCRATCH[-1].append(back)
    return back


@contextmanager
def scratch() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables cut inside are deleted at the end, but for those given to the function that this yields; these belong to the scratch
    around it, if there is one. Only for work whose results read no other table that was cut inside."""
    made: list[DataFrame] = []
    kept: set[str] = set()
    _SCRATCH.append(made)

    def keep(df: DataFrame) -> DataFrame:
        kept.add(df._quire_path)
        return df

    try:
        yield keep
    finally:
        _SCRATCH.pop()
        for df in made:
            if df._quire_path in kept:
                if _SCRATCH:
                    _SCRATCH[-1].append(df)
            else:
                discard(df)


def discard(df: DataFrame) -> None:
    """Delete what cut() wrote for df, once nothing reads it any more."""
    path = getattr(df, "_quire_path", None)
    if path:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)


def small_batches(spark: SparkSession, rows: int = 2048) -> None:
    """Hold Arrow batches of this session to so many rows. Batches are counted in rows, so with whole texts in them the
    default of 10,000 takes hundreds of MB of an executor outside its heap."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> str:
    """A column name as it must be written where names are parsed (it may hold a dot)."""
    return "`" + name.replace("`", "``") + "`"


def columns(names: Iterable[str]) -> list[Column]:
    return [F.col(quoted(c)) for c in names]


def map_rows(docs: DataFrame, run: Callable[[Iterator], Iterator], more: StructType) -> DataFrame:
    """docs with the columns of more, which run adds to Arrow batches whose columns have plain names (c0, c1, ...): mapInArrow
    refuses names with a dot."""
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    return plain.mapInArrow(run, StructType([*plain.schema.fields, *more.fields])).toDF(*docs.columns, *more.names)


def place(docs: DataFrame, name: str) -> int:
    """The number of a column."""
    return [c.lower() for c in docs.columns].index(name.lower())


def order_id(col: str) -> Column:
    return F.coalesce(F.col(quoted(col)).cast("long"), F.lit(NULL_ID).cast("long"))
