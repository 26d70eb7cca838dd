"""Secret scans over an incremental blob ledger, in DataFrame expressions alone.

Every version of a text is a blob named by its SHA-256. A ledger table holds, for each (blob, rule, rule version) ever
scanned, the spans found. scan() reads the ledger, scans the pairs that are not in it, appends them, and joins the
findings back to every path that holds the blob, in this run or an earlier one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import cut, fresh, quoted, scratch, scratch_path, table


@dataclass(frozen=True)
class Rule:
    """A kind of secret. Matches are leftmost and do not overlap; those whose group has fewer than least characters are dropped."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0


# The three base rules and the rules added to them, in the order in which their spans are listed.
RULES = (
    Rule("assign", 1, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
    Rule("pem", 1, r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
)
BASE = ("assign", "access", "hex")
SPAN = "array<struct<start:int,end:int>>"
#: Matches of a text whose lengths are added up at a time, and characters of a block of a text that is redacted.
SLICE, BLOCK = 256, 4096
LEDGER = f"blob binary, kind string, version int, spans {SPAN}"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once: what a lambda names from outside would be worked out in each of its calls."""
    return F.transform(F.array(value), body)[0]


def spans(text: Column, rule: Rule) -> Column:
    """The rule's spans in code points: the lengths of the pieces between matches and of the matches, added up from the left.

    Adding to an array copies it, so lengths are added up in slices first, and a text with n matches costs about n * SLICE + (n / SLICE) * n."""
    p, none = F.lit(rule.pattern), F.array().cast(SPAN)
    whole = F.regexp_extract_all(text, p, F.lit(0))
    kept = F.regexp_extract_all(text, p, F.lit(rule.group)) if rule.least else whole
    sized = lambda pieces: F.transform(pieces, lambda x: F.length(x))
    steps = F.arrays_zip(sized(F.split(text, rule.pattern, -1)).alias("gap"), sized(whole).alias("whole"), sized(kept).alias("kept"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        end = begin + x["whole"]
        one = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct(F.coalesce(end, begin).alias("at"), F.when(x["kept"] >= rule.least, F.concat(acc["found"], one)).otherwise(acc["found"]).alias("found"))

    def follow(acc: Column, x: Column) -> Column:
        moved = F.transform(x["found"], lambda s: F.struct((acc["at"] + s["start"]).alias("start"), (acc["at"] + s["end"]).alias("end")))
        return F.struct((acc["at"] + x["at"]).alias("at"), F.concat(acc["found"], F.array(moved)).alias("found"))

    begin = F.struct(F.lit(0).alias("at"), none.alias("found"))
    slices = let(steps, lambda z: F.transform(F.sequence(F.lit(0), F.floor((F.size(z) - 1) / SLICE).cast("int")), lambda k: F.aggregate(F.slice(z, k * SLICE + 1, F.lit(SLICE)), begin, step)))
    found = F.aggregate(slices, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("found")), follow, lambda acc: F.flatten(acc["found"]))
    return F.when(text.rlike(rule.pattern), found).otherwise(none)


def scan_blobs(blobs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """blobs (blob, text, todo: array of kinds to scan) to ledger rows, one for each scanned (blob, rule)."""
    each = [
        F.when(
            F.array_contains("todo", r.kind),
            F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), spans(F.col("text"), r).alias("spans")),
        )
        for r in rules
    ]
    return blobs.select("blob", F.explode(F.filter(F.array(*each), lambda x: x.isNotNull())).alias("x")).select("blob", "x.*")


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """The ledger at path, or None where there is none yet."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return None
    return spark.read.schema(LEDGER).parquet(path)


def scan(docs: DataFrame, key: str, text: str, ledger: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(key, blob, found) for every row: the blob of its text, and a map of kinds to spans (null if there are none).

    ledger is a folder that driver and executors share; it is made by the first scan, and later scans read only what they
    have not seen. Null text is the empty text, which has no finding. Repeated rows, a key with several texts (its
    versions) and null keys each keep their own findings, an empty table has no row and adds nothing to the ledger, other
    columns are ignored.

    A blob is scanned at one of the paths that hold it, the smallest key, and meets its text by both key and hash: the text
    moves once, whatever the number of copies, and versions of one key or rows without a key meet their own blob alone. Findings are joined to paths on the blob; that join has plain exchanges on
    both sides, so adaptive execution can split a blob that a third of all paths hold.
    """
    spark = docs.sparkSession
    wanted = {r.kind: r.version for r in rules}
    rows = docs.select(F.col(quoted(key)).alias("key"), F.coalesce(F.col(quoted(text)), F.lit("")).alias("text"))
    named = rows.withColumn("blob", F.unhex(F.sha2("text", 256)))
    paths = cut(named.select("key", "blob"), "paths")
    blobs = paths.groupBy("blob").agg(F.min("key").alias("first"))
    known = read_ledger(spark, ledger)
    every = F.array(*map(F.lit, wanted))
    if known is None:
        todo = blobs.withColumn("todo", every)
    else:
        seen = known.join(F.broadcast(spark.createDataFrame([*wanted.items()], "kind string, version int")), ["kind", "version"], "left_semi")
        done = seen.groupBy("blob").agg(F.collect_set("kind").alias("done"))
        todo = blobs.join(done, "blob", "left").withColumn("todo", F.array_except(every, F.coalesce("done", F.array().cast("array<string>")))).drop("done")
        todo = todo.filter(F.size("todo") > 0)
    todo = cut(todo.select(F.col("first").alias("key"), "blob", "todo"), "unseen")
    # repeated rows give the same ledger row
    todo = todo.select(F.col("key").alias("key_"), F.col("blob").alias("blob_"), "todo")
    picked = named.join(todo, F.col("key").eqNullSafe(F.col("key_")) & (F.col("blob") == F.col("blob_"))).select("blob", "text", "todo")
    scan_blobs(picked, rules).write.mode("append").parquet(ledger)
    found = spark.read.schema(LEDGER).parquet(ledger)
    current = F.lit(False)
    for kind, version in wanted.items():
        current = current | ((F.col("kind") == kind) & (F.col("version") == version))
    found = cut(found.filter(current & (F.size("spans") > 0)).dropDuplicates(["blob", "kind"]).groupBy("blob").agg(F.map_from_entries(F.collect_list(F.struct("kind", "spans"))).alias("found")), "findings")
    return paths.join(found, "blob", "left").withColumnRenamed("key", key)


def listing(found: Column, kinds: Sequence[str], rank: dict[str, int]) -> Column:
    """kind:start:end of the kinds' spans, by start, then by the kinds' order, joined by commas."""
    def said(kind: str) -> Column:
        none = F.array().cast(SPAN)
        return F.transform(
            F.coalesce(found[kind], none),
            lambda s: F.struct(s["start"].alias("start"), F.lit(rank[kind]).alias("rank"), F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")).alias("said")),
        )

    parts = [said(k) for k in kinds]
    return F.array_join(F.transform(F.array_sort(F.concat(*parts)), lambda s: s["said"]), ",")


def _cuts(marks: DataFrame) -> DataFrame:
    """(blob, cuts) of (blob, start, end): overlapping spans as one, cut where blocks of BLOCK characters end; cuts maps a block to its
    (lo, hi, is_first), the places in the block and whether the span starts there."""
    w = Window.partitionBy("blob").orderBy("start", "end")
    reach = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = marks.withColumn("opens", F.when(reach > F.col("start"), 0).otherwise(1))
    merged = opens.withColumn("run", F.sum("opens").over(w.rowsBetween(Window.unboundedPreceding, 0))).groupBy("blob", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    block = lambda c: F.floor(c / BLOCK).cast("int")
    touched = merged.withColumn("block", F.explode(F.sequence(block(F.col("start")), block(F.col("end") - 1))))
    first = F.col("block") * BLOCK
    one = F.struct(F.greatest(F.col("start") - first, F.lit(0)).alias("lo"), F.least(F.col("end") - first, F.lit(BLOCK)).alias("hi"), (F.col("start") >= first).alias("is_first"))
    blocks = touched.groupBy("blob", "block").agg(F.array_sort(F.collect_list(one)).alias("x"))
    return blocks.groupBy("blob").agg(F.map_from_entries(F.collect_list(F.struct("block", "x"))).alias("cuts"))


def redact(docs: DataFrame, key: str, text: str, ledger: str, rules: Sequence[Rule] = RULES, mark: str = "[secret]") -> DataFrame:
    """docs with every found span of text replaced by mark; overlapping spans become one mark. All columns stay, whatever
    their names; null text stays null, repeated rows and null keys stay as rows, an empty table stays empty.

    A place in a text is found by counting from its start, so a text is first cut into blocks, and spans are dealt over them."""
    body, blob, at = F.col(quoted(text)), fresh(docs, "blob"), fresh(docs, "cuts")
    with scratch() as keep:
        marks = scan(docs, key, text, ledger, rules).filter("found IS NOT NULL").select("blob", F.flatten(F.map_values("found")).alias("spans")).dropDuplicates(["blob"])
        found = keep(cut(_cuts(marks.select("blob", F.inline("spans"))).select(F.col("blob").alias(blob), F.col("cuts").alias(at)), "redactions"))

    def block(x: Column, number: Column) -> Column:
        def step(acc: Column, c: Column) -> Column:
            gap = F.substring(x, acc["at"] + 1, c["lo"] - acc["at"])
            return F.struct(c["hi"].alias("at"), F.concat(acc["kept"], gap, F.when(c["is_first"], F.lit(mark)).otherwise(F.lit(""))).alias("kept"))

        start = F.struct(F.lit(0).alias("at"), F.lit("").alias("kept"))
        clean = F.aggregate(F.try_element_at(F.col(at), number), start, step, lambda acc: F.concat(acc["kept"], F.substring(x, acc["at"] + 1, F.lit(BLOCK))))
        return F.coalesce(clean, x)

    blocks = F.regexp_extract_all(body, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    joined = docs.withColumn(blob, F.unhex(F.sha2(F.coalesce(body, F.lit("")), 256))).join(found, blob, "left")
    told = F.when(F.col(at).isNotNull() & body.isNotNull(), F.array_join(F.transform(blocks, block), "")).otherwise(body).alias(text)
    return joined.select(*(told if c.lower() == text.lower() else F.col(quoted(c)) for c in docs.columns))


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two scans over one ledger: the base rules come first, and when the method's own join them, only these are left to scan."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rank = {r.kind: i for i, r in enumerate(RULES)}
    ledger = scratch_path(spark, "ledger")
    with scratch():
        scan(docs, "doc_id", "text", ledger, [r for r in RULES if r.kind in BASE])
    got = scan(docs, "doc_id", "text", ledger)
    count = lambda k: F.coalesce(F.size(F.col("found")[k]), F.lit(0)).cast("long")
    return got.select(
        "doc_id",
        *(F.greatest(count(k), F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE),
        F.sha2(listing(F.col("found"), BASE, rank), 256).alias("base_sha256"),
        listing(F.col("found"), [*rank], rank).alias("spans"),
    )
