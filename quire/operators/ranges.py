"""Range and set algebra over ordinals: expansion, islands, spans, scopes and membership.

A canon is a table (vsys, book, book_ord, testament, ch, last_vs); verse_index() gives every verse its ordinal, and all
range work is done on ordinals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def verse_index(canon: DataFrame) -> DataFrame:
    """One row per verse with ord, its place in the verse system, and the counts that tell first and last verses."""
    last = canon.withColumn("last_ch", F.max("ch").over(Window.partitionBy("vsys", "book")))
    rows = last.select("*", F.explode(F.expr("sequence(1, last_vs)")).alias("vs"))
    order = Window.partitionBy("vsys").orderBy("book_ord", "ch", "vs")
    return rows.withColumn("ord", F.row_number().over(order))


def parse_address(s: Column) -> Column:
    """`work:BOOK.CH.VS!ext` as a struct; parts that are not there are null."""
    body = F.regexp_replace(s, "^[\\w-]+:", "")
    part = lambda p, g: F.nullif(F.regexp_extract(body, p, g), F.lit(""))
    shape = "^([^.!]+)(?:\\.(\\d+))?(?:\\.(\\d+))?(?:!(.*))?$"
    return F.struct(
        F.nullif(F.regexp_extract(s, "^([\\w-]+):", 1), F.lit("")).alias("work"),
        part(shape, 1).alias("book"), part(shape, 2).cast("int").alias("ch"), part(shape, 3).cast("int").alias("vs"), part(shape, 4).alias("ext"),
    )


def expand_refs(refs: DataFrame, index: DataFrame, key: str, ref: str, vsys: str) -> DataFrame:
    """RG1: every verse of every segment of a reference list. A segment is an address or a-b; a book or chapter stands for
    all its verses, OT and NT for a testament. Columns: key, seg (from 0), ord, book, ch, vs."""
    idx = index.filter(F.col("vsys") == vsys)
    segs = refs.select(F.col(key), F.posexplode(F.filter(F.split(F.col(ref), "\\s+"), lambda x: x != "")).alias("seg", "part"))
    ends = segs.withColumn("a", parse_address(F.substring_index("part", "-", 1))).withColumn("b", parse_address(F.substring_index("part", "-", -1)))
    # the canon is a dimension of some thousand verses, whatever the references are
    bounds = []
    for side, pick in (("a", F.min), ("b", F.max)):
        books = idx.groupBy("book").agg(F.min("ord").alias("o1"), F.max("ord").alias("o2")).select(F.concat_ws(".", "book").alias("id"), "o1", "o2")
        chapters = idx.groupBy("book", "ch").agg(F.min("ord").alias("o1"), F.max("ord").alias("o2")).select(F.concat_ws(".", "book", F.col("ch").cast("string")).alias("id"), "o1", "o2")
        verses = idx.select(F.concat_ws(".", "book", F.col("ch").cast("string"), F.col("vs").cast("string")).alias("id"), F.col("ord").alias("o1"), F.col("ord").alias("o2"))
        halves = idx.groupBy("testament").agg(F.min("ord").alias("o1"), F.max("ord").alias("o2")).select(F.col("testament").alias("id"), "o1", "o2")
        bounds.append(books.unionByName(chapters).unionByName(verses).unionByName(halves).select(F.col("id").alias(f"id_{side}"), (F.col("o1") if pick is F.min else F.col("o2")).alias(f"ord_{side}")))
    keyed = ends.withColumn("id_a", F.concat_ws(".", "a.book", F.col("a.ch").cast("string"), F.col("a.vs").cast("string"))).withColumn("id_b", F.concat_ws(".", "b.book", F.col("b.ch").cast("string"), F.col("b.vs").cast("string")))
    spans = keyed.join(bounds[0], "id_a").join(bounds[1], "id_b").filter("ord_a <= ord_b")
    verses = spans.select(key, "seg", F.explode(F.sequence("ord_a", "ord_b")).alias("ord"))
    return verses.join(idx.select("ord", "book", "ch", "vs"), "ord").select(key, "seg", "ord", "book", "ch", "vs")


def expand(df: DataFrame, low: str, high: str, name: str) -> DataFrame:
    """RG1 on plain ordinals: a row for each number from low to high; rows with low > high give none."""
    return df.filter(F.col(low) <= F.col(high)).select("*", F.explode(F.sequence(low, high)).alias(name))


#: Ordinals of a block, and rows of a task on average.
BLOCK, TASK = 2**16, 2**18


def compress(df: DataFrame, by: Sequence[str], ordinal: str, breaks: Sequence[str] = ()) -> DataFrame:
    """RG3: gaps and islands: runs of consecutive ordinals as (by, lo, hi, n). breaks: columns that a run never crosses
    (chapters, say). Repeated ordinals count once; a null ordinal is a run of its own.

    A key's ordinals are cut into blocks, each ordered on its own, so a task's rows have a bound (rows are counted first) and a large
    key is no task of its own. Only runs that touch the end of a block are put together across blocks: two a block at most."""
    keys = [*by, *breaks]
    rows = df.select(*keys, F.col(ordinal).alias("__o")).withColumn("__b", F.floor(F.col("__o") / BLOCK))
    tasks = -(-rows.count() // TASK) or 1
    w = Window.partitionBy(*keys, "__b").orderBy("__o")
    o, before, behind = F.col("__o"), F.lag("__o").over(w), F.lead("__o").over(w)
    first, last = before.isNull() | (o > before + 1), F.lead(F.lit(1)).over(w).isNull() | (behind > o + 1)
    marked = rows.repartition(tasks, *keys, "__b").select(*keys, "__b", "__o", F.when(first, o).alias("__first"), last.alias("__last"))
    begun = marked.withColumn("lo", F.last("__first", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = begun.filter("__last").select(*keys, "lo", F.col("__o").alias("hi"), F.coalesce(F.col("__o") - F.col("lo") + 1, F.lit(1)).cast("long").alias("n"))
    at_edge = F.coalesce((F.pmod("lo", F.lit(BLOCK)) == 0) | (F.pmod("hi", F.lit(BLOCK)) == BLOCK - 1), F.lit(False))
    e = Window.partitionBy(*keys).orderBy("lo")
    edges = runs.filter(at_edge).withColumn("__new", F.when(F.col("lo") == F.lag("hi").over(e) + 1, 0).otherwise(1)).withColumn("__run", F.sum("__new").over(e))
    joined = edges.groupBy(*keys, "__run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n")).drop("__run")
    return runs.filter(~at_edge).unionByName(joined)


def heal(df: DataFrame, by: Sequence[str], ordinal: str) -> DataFrame:
    """RG6: from the first to the last, gaps filled."""
    return df.groupBy(*by).agg(F.min(ordinal).alias("lo"), F.max(ordinal).alias("hi"))


def scope_string(verses: DataFrame, index: DataFrame, by: Sequence[str], vsys: str) -> DataFrame:
    """RG4: the shortest scope of a set of (book, ch, vs): whole books and chapters collapse, X-X is X, books outside the
    system come last in name order."""
    idx = index.filter(F.col("vsys") == vsys)
    known = verses.join(idx.select("book", "ch", "vs", "ord", "book_ord", "last_vs", "last_ch"), ["book", "ch", "vs"])
    runs = compress(known, by, "ord")
    ends = idx.select("ord", "book", "ch", "vs", "last_vs", "last_ch")
    joined = runs.join(ends.select(*(F.col(c).alias(f"a_{c}") for c in ends.columns)), F.col("lo") == F.col("a_ord")).join(ends.select(*(F.col(c).alias(f"b_{c}") for c in ends.columns)), F.col("hi") == F.col("b_ord"))
    opens_book, opens_ch = (F.col("a_ch") == 1) & (F.col("a_vs") == 1), F.col("a_vs") == 1
    ends_ch = F.col("b_vs") == F.col("b_last_vs")
    ends_book = ends_ch & (F.col("b_ch") == F.col("b_last_ch"))
    whole_books, whole_chapters = opens_book & ends_book, opens_ch & ends_ch
    name = lambda s: F.when(whole_books, F.col(f"{s}_book")).when(whole_chapters, F.concat_ws(".", f"{s}_book", F.col(f"{s}_ch").cast("string"))).otherwise(F.concat_ws(".", f"{s}_book", F.col(f"{s}_ch").cast("string"), F.col(f"{s}_vs").cast("string")))
    said = F.when(name("a") == name("b"), name("a")).otherwise(F.concat(name("a"), F.lit("-"), name("b")))
    text = joined.select(*by, F.struct(F.lit(0).alias("extra"), F.col("lo").cast("long").alias("at"), said.alias("said")).alias("__s"))
    extra = verses.join(idx.select("book").distinct(), "book", "left_anti").select(*by, F.struct(F.lit(1).alias("extra"), F.lit(0).cast("long").alias("at"), F.col("book").alias("said")).alias("__s")).distinct()
    return text.unionByName(extra).groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list("__s")), lambda s: s["said"]), " ").alias("scope"))


def _cover(low: Column, high: Column, levels: int) -> Column:
    """The blocks (level, at) that make up low..high: at level k a block is 8**k numbers long, and no two overlap. At most 14 a
    level: those before the first and behind the last whole block of the next level."""
    up = lambda x, bits: -F.shiftright(-x, bits)
    of = lambda k: lambda x: F.struct(F.lit(k).alias("level"), x.alias("at"))
    blocks = []
    for k in range(levels):
        a, b = up(low, 3 * k), F.shiftright(high + 1, 3 * k)  # blocks a..b - 1 lie within low..high
        left = F.least(b, 8 * up(low, 3 * k + 3))
        right = F.greatest(left, 8 * F.shiftright(high + 1, 3 * k + 3))
        blocks += [F.when((a < b) & (first < end), F.transform(F.sequence(first, end - 1), of(k))) for first, end in ((a, left), (right, b))]
    return F.flatten(F.filter(F.array(*blocks), lambda x: x.isNotNull()))


def in_range(points: DataFrame, ranges: DataFrame, point: str, low: str, high: str, by: Sequence[str] = (), longest: int | None = None) -> DataFrame:
    """JN13: points within ranges (both ends belong to them), a row for each pair. A range becomes the blocks that make it up, in a
    tree of blocks of 8: a few for each level, so a long range makes hardly more rows than a short one; a point is in one block of
    each level. So it is an equi-join without a filter behind it: what is shuffled is near the input and the result. The number of
    levels follows the longest range (asked of the table, unless the caller knows a bound). Ranges with low > high and nulls give nothing."""
    fit = ranges.filter(F.col(low) <= F.col(high))
    longest = longest or fit.agg(F.max(F.col(high).cast("long") - F.col(low).cast("long") + 1)).first()[0] or 1
    levels = max(1, -(-int(longest).bit_length() // 3))
    p = points.filter(F.col(point).isNotNull()).withColumn("__n", F.col(point).cast("long"))
    p = p.withColumn("__b", F.explode(F.array(*(F.struct(F.lit(k).alias("level"), F.shiftright("__n", 3 * k).alias("at")) for k in range(levels))))).drop("__n")
    r = fit.withColumn("__b", F.explode(_cover(F.col(low).cast("long"), F.col(high).cast("long"), levels)))
    # merged, not broadcast: the planner knows neither side's size, as blocks are more rows than what they are made from
    return p.join(r.hint("merge"), [*by, "__b"]).drop("__b")


def scope_books(refs: DataFrame, index: DataFrame, key: str, ref: str, vsys: str) -> DataFrame:
    """RG5: (key, book) of the books that a scope (a list of references) touches."""
    return expand_refs(refs, index, key, ref, vsys).select(key, "book").distinct()


def books_scope(books: DataFrame, index: DataFrame, by: Sequence[str], vsys: str) -> DataFrame:
    """RG5: (by, scope) of sets of books (by, book): the shortest scope of all their verses. Books that the system lacks are named last."""
    idx = index.filter(F.col("vsys") == vsys).select("book", "ch", "vs")
    every = books.select(*by, "book").distinct()
    missing = every.join(idx.select("book").distinct(), "book", "left_anti").select(*by, "book", F.lit(None).cast("int").alias("ch"), F.lit(None).cast("int").alias("vs"))
    return scope_string(every.join(idx, "book").select(*by, "book", "ch", "vs").unionByName(missing), index, by, vsys)


def in_scope(verses: DataFrame, scopes: DataFrame, index: DataFrame, key: str, scope: str, vsys: str) -> DataFrame:
    """RG5: (key, book, ch, vs) of the verses (book, ch, vs) that are members of each scope."""
    return expand_refs(scopes, index, key, scope, vsys).select(key, "book", "ch", "vs").distinct().join(verses.select("book", "ch", "vs").distinct(), ["book", "ch", "vs"], "left_semi").select(key, "book", "ch", "vs")


def overlaps(a: Column, b: Column) -> Column:
    """RG9: whether two lists have an element in common."""
    return F.arrays_overlap(a, b)


def normalise_list(refs: Column, policy: str = "present", default: str = "") -> Column:
    """RG2: a list's distinct segments; prefix policy: `present` as they are, `always` with the default work where there
    is none, `not-default` without the default work."""
    parts = F.filter(F.split(refs, "\\s+"), lambda x: x != "")
    if policy == "always":
        parts = F.transform(parts, lambda x: F.when(F.instr(x, ":") > 0, x).otherwise(F.concat(F.lit(default + ":"), x)))
    elif policy == "not-default":
        parts = F.transform(parts, lambda x: F.regexp_replace(x, f"^{default}:", ""))
    return F.array_distinct(parts)


def edit_set(base: Column, add: Column, remove: Column) -> Column:
    """RG7: segments added to and removed from a set."""
    return F.array_except(F.array_union(base, add), remove)


def external_refs(df: DataFrame, key: str, text: str, books: DataFrame) -> DataFrame:
    """RG10: `GEN 1:2-4, EXO 5` to addresses (books: abbr, book). What cannot be read comes back unchanged with parsed false.
    Chapter ranges are expanded to both ends."""
    items = df.select(key, F.posexplode(F.split(F.col(text), "\\s*[,;]\\s*")).alias("item", "part"))
    shape = "^(\\w+)(?:\\s+(\\d+)(?::(\\d+))?(?:-(?:(\\d+):)?(\\d+))?)?$"
    g = lambda i: F.nullif(F.regexp_extract("part", shape, i), F.lit(""))
    read = items.withColumn("abbr", F.upper(g(1))).withColumn("ch", g(2)).withColumn("vs", g(3)).withColumn("lch", g(4)).withColumn("last", g(5)).join(books, "abbr", "left")
    first = F.concat_ws(".", "book", "ch", "vs")
    end = F.when(F.col("last").isNull(), None).when(F.col("vs").isNull(), F.concat_ws(".", "book", "last")).otherwise(F.concat_ws(".", F.col("book"), F.coalesce("lch", "ch"), F.col("last")))
    ok = F.col("book").isNotNull()
    return read.select(key, "item", F.when(ok, F.concat_ws("-", first, end)).otherwise(F.col("part")).alias("ref"), ok.alias("parsed"))


def chapter_limited(start: Column, end: Column) -> Column:
    """RG11: a range cut off at the end of its first chapter: an end in another chapter is dropped."""
    chapter = lambda x: F.substring_index(x, ".", 2)
    return F.when(end.isNull() | (chapter(start) != chapter(end)), start).otherwise(F.concat(start, F.lit("-"), end))


def address_order(address: Column) -> list[Column]:
    """ST1: sort columns: work, then ids that are no verse, unknown books first, canon order (book_ord), chapter, verse."""
    a = parse_address(address)
    return [a["work"].asc_nulls_first(), (a["vs"].isNotNull()).asc(), F.col("book_ord").asc_nulls_first(), a["ch"].asc_nulls_first(), a["vs"].asc_nulls_first()]
