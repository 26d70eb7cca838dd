"""Verse-system reconciliation: instructions become pieces of a map, the pieces map verses, maps retarget references.

Instead of rewriting a tree for each instruction, the instructions of a book are folded into a map that is a shift of chapter and
verse on each of a few intervals: sums over the instructions before an interval tell its shift. See map_pieces().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.plans.graph import checkpoints

SHAPE = "^VSYS_([A-Z_]+):\\s*([A-Za-z0-9]+)\\.(\\d+)(?:\\.(\\d+))?(?:\\.(\\d+|PART))?(?:\\s*->\\s*([A-Za-z0-9]+)\\.(\\d+)(?:\\.(\\d+))?(?:\\.(\\d+))?)?\\s*$"
#: Stands between the groups of a line; no line that fits SHAPE holds it.
CUT = "\x1f"


def instructions(lines: DataFrame, raw: str = "raw") -> DataFrame:
    """VM1/VM10: VSYS_ lines as (seq, op, book, ch, vs, lv, partial, to_book, to_ch, to_vs, to_lv, valid)."""
    # a line is matched once: its groups in a row, taken apart; the explode keeps filters from matching it anew
    groups = F.split(F.regexp_replace(F.col(raw), SHAPE, "".join(f"${i}{CUT}" for i in range(1, 10))), CUT)
    read = lines.filter(F.col(raw).startswith("VSYS_")).select("line_no", F.explode(F.array(F.when(~F.contains(F.col(raw), F.lit(CUT)), groups))).alias("__g"))
    g = lambda i: F.when(F.size("__g") == 10, F.nullif(F.get("__g", F.lit(i - 1)), F.lit("")))
    num = lambda i: g(i).try_cast("int")
    rows = read.select("line_no", g(1).alias("op"), g(2).alias("book"), num(3).alias("ch"), num(4).alias("vs"), num(5).alias("lv"), (g(5) == "PART").alias("partial"), g(6).alias("to_book"), num(7).alias("to_ch"), num(8).alias("to_vs"), num(9).alias("to_lv"))
    last = lambda a, b: F.coalesce(b, a)
    counts = (last(F.col("vs"), F.col("lv")) - F.col("vs")).eqNullSafe(last(F.col("to_vs"), F.col("to_lv")) - F.col("to_vs"))
    return rows.withColumn("lv", last(F.col("vs"), F.col("lv"))).withColumn("partial", F.coalesce("partial", F.lit(False))).withColumn("valid", F.col("op").isNotNull() & (F.col("to_book").isNull() | counts) & (F.col("lv").isNull() | (F.col("lv") >= F.col("vs"))))


#: The order in which instructions take effect.
RANK = {"FROM_TO": 0, "MOVED": 1, "CHAPTER_SPLIT_AT": 2, "EXTRA": 3, "MISSING": 4, "MISSING_FN": 5}


def instruction_order() -> list[Column]:
    """ST10: type, then first and last verse."""
    rank = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in RANK.items() for x in kv)), F.col("op")), F.lit(9))
    return [rank, F.col("book"), F.col("ch"), F.col("vs"), F.col("lv")]


def primitives(inst: DataFrame, index: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """VM1: instructions as the primitive ones that they stand for (same columns): MISSING, EXTRA, CHAPTER_SPLIT_AT, FROM_TO (without a
    target where there is none), MOVED (to another book), VTAG_MISSING. MISSING also says that the verses have no source; MOVED within
    a book is FROM_TO, MISSING where it was and EXTRA where it is; MOVED_ALT is MISSING and FROM_TO; EMPTY is FROM_TO without a
    target; MISSING_FN is VTAG_MISSING. Partial verses move no number. A whole chapter (vs is null) gets its verses from index (book, ch,
    vs), for EXTRA from source (the same of the source's chapters); without them it says nothing."""
    made = {
        "MISSING": ("MISSING", "FROM_TO"), "EXTRA": ("EXTRA",), "FROM_TO": ("FROM_TO",), "EMPTY": ("FROM_TO",), "CHAPTER_SPLIT_AT": ("CHAPTER_SPLIT_AT",),
        "MOVED_ALT": ("MISSING", "FROM_TO"), "MISSING_FN": ("VTAG_MISSING",), "MOVED_HERE": ("FROM_TO", "MISSING", "EXTRA"), "MOVED_AWAY": ("FROM_TO", "MOVED"),
    }
    kind = F.when(F.col("op") == "MOVED", F.when(F.col("to_book") == F.col("book"), "MOVED_HERE").otherwise("MOVED_AWAY")).otherwise(F.col("op"))
    table = F.create_map(*(x for k, v in made.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    rows = inst.filter("valid").withColumn("__op", F.explode(F.element_at(table, kind)))
    # EXTRA tells of source verses: those that a move goes to
    there = (F.col("__op") == "EXTRA") & F.col("to_book").isNotNull()
    at = {c: F.when(there, F.col(f"to_{c}")).otherwise(F.col(c)).alias(c) for c in ("book", "ch", "vs", "lv")}
    rows = rows.filter(~(F.col("partial") & F.col("__op").isin("MISSING", "EXTRA"))).select(*(at.get(c, F.col("__op").alias("op") if c == "op" else F.col(c)) for c in inst.columns))
    rows = rows.withColumn("lv", F.coalesce("lv", "vs"))
    chapters = index.select(F.lit(False).alias("__source"), "book", "ch", "vs")
    if source is not None:
        chapters = chapters.unionByName(source.select(F.lit(True).alias("__source"), "book", "ch", "vs"))
    sizes = chapters.groupBy("__source", "book", "ch").agg(F.max("vs").alias("__last"))
    whole = rows.withColumn("__source", F.col("op") == "EXTRA").join(sizes.hint("merge"), ["__source", "book", "ch"], "left")
    whole = whole.withColumn("lv", F.coalesce("lv", "__last")).withColumn("vs", F.when(F.col("lv").isNotNull(), F.coalesce("vs", F.lit(1))))
    return whole.filter("vs IS NOT NULL").select(*inst.columns)


def _intervals(rows: DataFrame, by: list[str]) -> DataFrame:
    """(by, vs, lv) with overlapping and touching intervals made one."""
    w = Window.partitionBy(*by).orderBy("vs", "lv")
    before = F.max("lv").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = rows.select(*by, "vs", "lv").withColumn("__new", F.when(before.isNull() | (F.col("vs") > before + 1), 1).otherwise(0))
    return marked.withColumn("__run", F.sum("__new").over(w)).groupBy(*by, "__run").agg(F.min("vs").alias("vs"), F.max("lv").alias("lv")).drop("__run")


def map_pieces(index: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """VM2/VM3/VM5: the instructions (rows of primitives()) of each book folded into a map of its fixed verses, as two tables of intervals.

    (book, ch, low, high, gone, src_ch, base): fixed verses low..high of a chapter are verses of source chapter src_ch, and n - base is
    the place of verse n among those that the fixed system has there too; where gone, the source has none of them.
    (book, src_ch, low, high, by): places low..high of a source chapter have numbers larger by `by`, as so many extra verses stand before.

    A chapter split sends what stands behind it in the book one chapter further, so a chapter's offset is the number of splits before
    it (a prefix sum over the book), and splits of one chapter add up. The number of a verse is its own, less the verse that the last
    split stands at, less the missing verses since then (a prefix sum over the chapter), plus the extra verses before it (over the
    source chapter). Only instructions and chapters are summed, not verses. high is null where an interval has no end."""
    splits = rows.filter("op = 'CHAPTER_SPLIT_AT'").select("book", "ch", "vs").distinct()
    gone = _intervals(rows.filter("op = 'MISSING'"), ["book", "ch"])
    # splits in the chapters before
    chapters = index.select("book", "ch", F.lit(0).alias("n")).distinct().unionAll(splits.select("book", "ch", F.lit(1).alias("n"))).groupBy("book", "ch").agg(F.sum("n").alias("n"))
    ahead = F.coalesce(F.sum("n").over(Window.partitionBy("book").orderBy("ch").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("int")
    # where anything changes in a chapter: its beginning (without vs, so it comes first), splits, and both ends of what is missing
    zero = F.lit(0)
    mark = lambda vs, split, turn, lost: F.struct(vs.alias("vs"), split.alias("split"), turn.alias("turn"), lost.alias("lost"))
    marks = chapters.select("book", "ch", ahead.alias("ahead"), mark(F.lit(None).cast("int"), zero, zero, zero).alias("m"))
    none = F.lit(None).cast("int").alias("ahead")
    marks = marks.unionByName(splits.select("book", "ch", none, mark(F.col("vs"), F.lit(1), zero, zero).alias("m")))
    ends = F.array(mark(F.col("vs"), zero, F.lit(1), zero), mark(F.col("lv") + 1, zero, F.lit(-1), F.col("lv") - F.col("vs") + 1))
    marks = marks.unionByName(gone.select("book", "ch", none, F.explode(ends).alias("m"))).select("book", "ch", "ahead", "m.*")
    marks = marks.groupBy("book", "ch", "vs").agg(F.max("ahead").alias("ahead"), *(F.sum(c).cast("int").alias(c) for c in ("split", "turn", "lost")))
    w = Window.partitionBy("book", "ch").orderBy("vs")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    opened = F.last(F.when(F.col("turn") > 0, F.col("vs")), ignorenulls=True).over(upto)
    state = marks.withColumn("gone", F.sum("turn").over(upto) > 0).withColumn("lost", F.sum("lost").over(upto)).withColumn("opened", opened).withColumn("splits", F.sum("split").over(upto))
    state = state.withColumn("high", F.lead("vs").over(w) - 1)
    # missing verses before a split that stands within them are lost ahead of it
    lost_there = F.col("lost") + F.when(F.col("gone"), F.col("vs") - F.col("opened")).otherwise(0)
    state = state.withColumn("from_vs", F.last(F.when(F.col("split") > 0, F.col("vs") - 1), ignorenulls=True).over(upto)).withColumn("from_lost", F.last(F.when(F.col("split") > 0, lost_there), ignorenulls=True).over(upto))
    base = F.coalesce("from_vs", F.lit(0)) + F.col("lost") - F.coalesce("from_lost", F.lit(0))
    before = F.first("ahead", ignorenulls=True).over(Window.partitionBy("book", "ch"))
    # instructions for chapters that the index has not got say nothing
    pieces = state.withColumn("ahead", before).filter("ahead IS NOT NULL").select("book", "ch", F.col("vs").alias("low"), "high", "gone", (F.col("ch") + F.col("ahead") + F.col("splits")).cast("int").alias("src_ch"), base.cast("int").alias("base"))
    extra = _intervals(rows.filter("op = 'EXTRA'"), ["book", "ch"])
    e = Window.partitionBy("book", "ch").orderBy("vs")
    size = F.col("lv") - F.col("vs") + 1
    before = F.coalesce(F.sum(size).over(e.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    later = extra.withColumn("low", F.col("vs") - before).withColumn("by", before + size)
    later = later.withColumn("high", F.lead("low").over(e) - 1)
    return pieces, later.select("book", F.col("ch").alias("src_ch"), F.col("low").cast("int").alias("low"), F.col("high").cast("int").alias("high"), F.col("by").cast("int").alias("by"))


def verse_maps(index: DataFrame, inst: DataFrame, source: DataFrame | None = None, extra: bool = False) -> DataFrame:
    """VM2-VM6/D10: fixed verses (index: book, ch, vs; not repeated) with their source verses, as (fixed_id, src_id, alt_label, status).

    status: `same`, `moved` (another number, or FROM_TO to another place), `missing` (the source has none; the verse before it in the
    chapter stands for it, or the one behind it where none is before) or, if extra is set, `extra` (a source verse without a fixed one, with the fixed
    verse that it is appended to: the one before it, or the first behind it at a book's beginning). Without `missing` and `extra` the
    map is one to one. alt_label: the source's number where it is another, with the chapter's if that is another too.
    source: (book, ch, vs) of the source's chapters, for EXTRA of a whole chapter at a book's end.

    No join is a broadcast: the planner takes the size of a packed file for that of the verses made from it, which the driver would get.
    Verses meet their interval in one ordered line of both (see _standing()), not by a join."""
    checkpoints(index.sparkSession)
    rows = primitives(inst, index, source).checkpoint()
    pieces, later = map_pieces(index, rows)
    placed = _standing(index.select("book", "ch", "vs").na.drop(), pieces.select("book", "ch", "low", F.struct("gone", "src_ch", "base").alias("said")), ["book", "ch"], "vs")
    kept = lambda c: F.when(~F.col("said.gone"), c)
    placed = placed.select("book", "ch", "vs", kept(F.col("said.src_ch")).alias("src_ch"), kept(F.col("vs") - F.col("said.base")).alias("place"))
    # verses without a source stay with their chapter; extra verses say nothing of them
    placed = placed.withColumn("group", F.coalesce("src_ch", -F.col("ch")))
    shifted = _standing(placed, later.select("book", F.col("src_ch").alias("group"), "low", F.struct("by").alias("said")), ["book", "group"], "place")
    found = shifted.select("book", "ch", "vs", "src_ch", (F.col("place") + F.coalesce("said.by", F.lit(0))).cast("int").alias("src_vs")).checkpoint()
    numbered = found.filter("src_vs IS NOT NULL")
    # a missing verse has the source of the last one before it in its chapter, else of the first behind it
    w = Window.partitionBy("book", "ch").orderBy("vs")
    src = F.when(F.col("src_vs").isNotNull(), F.struct(F.col("book").alias("b"), F.col("src_ch").alias("c"), F.col("src_vs").alias("v")))
    near = F.coalesce(F.last(src, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.first(src, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)))
    # what a FROM_TO says
    targets = rows.filter("op = 'FROM_TO' AND NOT partial AND to_book IS NOT NULL").select("book", "ch", F.explode(F.sequence("vs", "lv")).alias("vs"), F.col("vs").alias("__first"), "to_book", "to_ch", "to_vs")
    targets = targets.groupBy("book", "ch", "vs").agg(F.min(F.struct(F.col("to_book").alias("b"), F.col("to_ch").alias("c"), (F.col("to_vs") + F.col("vs") - F.col("__first")).alias("v"))).alias("target"))
    # in one exchange with the line of near verses
    both = found.withColumn("here", F.lit(True)).unionByName(targets.withColumn("here", F.lit(False)), allowMissingColumns=True)
    both = both.withColumn("target", F.first("target", ignorenulls=True).over(Window.partitionBy("book", "ch", "vs"))).filter("here")
    told = both.withColumn("near", near).withColumn("lost", F.col("src_vs").isNull() & F.col("target").isNull()).withColumn("src", F.coalesce("target", "near"))
    fixed, source_id = _ident(F.col("book"), F.col("ch"), F.col("vs")), _ident(F.col("src.b"), F.col("src.c"), F.col("src.v"))
    status = F.when(F.col("lost"), "missing").when(fixed == source_id, "same").otherwise("moved")
    label = F.when(status == "moved", F.concat(F.lit("("), F.when(F.col("src.c") != F.col("ch"), F.concat(F.col("src.c").cast("string"), F.lit(":"))).otherwise(""), F.col("src.v").cast("string"), F.lit(")")))
    told = told.select(fixed.alias("fixed_id"), F.when(F.col("src").isNotNull(), source_id).alias("src_id"), label.alias("alt_label"), status.alias("status"))
    if not extra:
        return told
    # extra verses follow the source verse before them in the book
    moved_to = targets.select(F.col("target.b").alias("book"), F.col("target.c").alias("src_ch"), F.col("target.v").alias("src_vs"))
    more = rows.filter("op = 'EXTRA'").select("book", F.col("ch").alias("src_ch"), F.explode(F.sequence("vs", "lv")).alias("src_vs")).distinct().join(moved_to.hint("merge"), ["book", "src_ch", "src_vs"], "left_anti")
    line = numbered.select("book", "src_ch", "src_vs", _ident(F.col("book"), F.col("ch"), F.col("vs")).alias("id")).unionByName(more.select("book", "src_ch", "src_vs", F.lit(None).cast("string").alias("id")))
    b = Window.partitionBy("book").orderBy("src_ch", "src_vs")
    host = F.coalesce(F.last("id", ignorenulls=True).over(b.rowsBetween(Window.unboundedPreceding, 0)), F.first("id", ignorenulls=True).over(b.rowsBetween(0, Window.unboundedFollowing)))
    hosted = line.withColumn("host", host).filter("id IS NULL")
    return told.unionByName(hosted.select(F.col("host").alias("fixed_id"), _ident(F.col("book"), F.col("src_ch"), F.col("src_vs")).alias("src_id"), F.lit(None).cast("string").alias("alt_label"), F.lit("extra").alias("status")))


def _standing(points: DataFrame, pieces: DataFrame, by: list[str], at: str) -> DataFrame:
    """points (by, at and more) with `said` of the piece (by, low, said) that each stands in: of those of its group the last that begins
    at or before it, or null before the first. A piece without low begins before all points. One exchange of both, and no row more."""
    line = points.withColumn("__point", F.lit(1)).unionByName(pieces.select(*by, F.col("low").alias(at), "said", F.lit(0).alias("__point")), allowMissingColumns=True)
    w = Window.partitionBy(*by).orderBy(F.asc_nulls_first(at), "__point").rowsBetween(Window.unboundedPreceding, 0)
    return line.withColumn("said", F.last("said", ignorenulls=True).over(w)).filter("__point = 1").drop("__point")


def _ident(book: Column, ch: Column, vs: Column) -> Column:
    return F.concat_ws(".", book, ch.cast("string"), vs.cast("string"))


def moved_map(inst: DataFrame) -> DataFrame:
    """VM4/VM6: FROM_TO and MOVED verse ranges as (map_from, map_to, partial), a row per verse."""
    rows = inst.filter(F.col("op").isin("FROM_TO", "MOVED") & F.col("valid") & F.col("to_book").isNotNull()).select("*", F.explode(F.sequence(F.lit(0), F.col("lv") - F.col("vs"))).alias("k"))
    ident = lambda b, c, v: F.concat_ws(".", b, F.col(c).cast("string"), (F.col(v) + F.col("k")).cast("string"))
    return rows.select(ident("book", "ch", "vs").alias("map_from"), ident("to_book", "to_ch", "to_vs").alias("map_to"), "partial")


def compose(first: DataFrame, second: DataFrame) -> DataFrame:
    """JN8: map_from to map_to through both maps; what the second does not map stays."""
    b = second.select(F.col("map_from").alias("map_to"), F.col("map_to").alias("__to"))
    return first.join(b, "map_to", "left").select("map_from", F.coalesce("__to", "map_to").alias("map_to"))


def retarget(verses: DataFrame, maps: DataFrame, key: str, index: DataFrame, missing: DataFrame | None = None) -> DataFrame:
    """JN7/VM9: references as verses (key, id) through a map (map_from, map_to), then compressed to ranges again.

    missing: ids that have no target; they are dropped. index: id, ord of the target system."""
    from quire.operators.ranges import compress

    v = verses.join(missing.select("id"), "id", "left_anti") if missing is not None else verses
    new = v.join(maps.select(F.col("map_from").alias("id"), "map_to"), "id", "left").select(key, F.coalesce("map_to", "id").alias("id"))
    runs = compress(new.join(index, "id").select(key, "ord"), [key], "ord")
    a, b = index.select(F.col("ord").alias("lo"), F.col("id").alias("a")), index.select(F.col("ord").alias("hi"), F.col("id").alias("b"))
    named = runs.join(a, "lo").join(b, "hi")
    text = F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(F.concat_ws("-", "a", "b"))
    return named.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("lo", text.alias("x")))), lambda s: s["x"]), " ").alias("refs"))


def join_missing(verses: DataFrame, missing: DataFrame) -> DataFrame:
    """VM7: missing verses (book, ch, vs) are added to the ids of the verse before them. verses: book, ch, vs, ids (array)."""
    before = missing.select("book", "ch", (F.col("vs") - 1).alias("vs"), F.concat_ws(".", "book", F.col("ch").cast("string"), F.col("vs").cast("string")).alias("__x"))
    more = before.groupBy("book", "ch", "vs").agg(F.array_sort(F.collect_list("__x")).alias("__more"))
    return verses.join(more, ["book", "ch", "vs"], "left").withColumn("ids", F.array_union("ids", F.coalesce("__more", F.array().cast("array<string>")))).drop("__more")
