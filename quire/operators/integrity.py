"""Reference integrity, reconciliation and rule-driven predicates: joins that end in findings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.operators.ranges import in_range
from quire.operators.scan import Scan, ordered
from quire.plans.graph import checkpoints


def dangling(refs: DataFrame, ids: DataFrame, ref: str, ident: str) -> DataFrame:
    """JN2/JN3/JN6: references whose target does not exist."""
    return refs.join(ids.select(F.col(ident).alias("__id")).distinct(), F.col(ref) == F.col("__id"), "left_anti")


#: References of a key that meet so many targets in one piece of work, and tasks of such pieces at most. The codecs of columnar files find
#: a block of targets again if it is short. Pieces are dealt by hash, several to some tasks, so they are small beside what a core makes.
REFS, TARGETS, TASKS = 2048, 1024, 10_000
#: A key whose matches would make so many pieces at most stays whole.
WHOLE = 8


def lookup(refs: DataFrame, targets: DataFrame, ref: str, ident: str) -> DataFrame:
    """JN1: keyed lookup on a list-valued key: both sides exploded, then an equi-join; a row for every match.

    A key with more matches than WHOLE pieces make is no task of its own: its rows are dealt over blocks on each side, and every block
    meets every block of the other side, so a piece of work has REFS * TARGETS matches at most. A row of refs comes with its block of targets
    in turn, again and again the same, which packs well. Keys are counted first; if none has so many matches, the rest is one lazy join."""
    left = refs.withColumn("__k", F.explode(F.split(F.trim(F.col(ref)), "\\s+")))
    right = targets.withColumn("__k", F.explode(F.split(F.trim(F.col(ident)), "\\s+")))
    counts = left.groupBy("__k").agg(F.count("*").alias("__n")).join(right.groupBy("__k").agg(F.count("*").alias("__m")), "__k")
    blocks = lambda n, size: F.ceil(F.col(n) / size).cast("int").alias(n)
    hot = counts.filter(F.col("__n").cast("double") * F.col("__m") > WHOLE * REFS * TARGETS).select("__k", blocks("__n", REFS), blocks("__m", TARGETS))
    if not (pieces := hot.agg(F.sum(F.col("__n").cast("double") * F.col("__m"))).first()[0]):
        return left.join(right, "__k").drop("__k")
    checkpoints(refs.sparkSession)
    hot = hot.checkpoint()

    def dealt(side: DataFrame, size: int, own: str, other: str, others: str) -> DataFrame:
        # a written table, since rows may have other numbers when a task runs again
        rows = side.join(hot, "__k").withColumn("__id", F.monotonically_increasing_id()).checkpoint()
        rows = ordered(rows, ["__k"], ["__id"], {"__at": Scan("number")}).withColumn(own, F.floor((F.col("__at") - 1) / size).cast("int"))
        rows = rows.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(others) - 1)))
        return rows.select(*side.columns, "__i", "__j").repartition(int(min(pieces, TASKS)), "__k", "__i", "__j")

    met = dealt(left, REFS, "__i", "__j", "__m").join(dealt(right, TARGETS, "__j", "__i", "__n").hint("merge"), ["__k", "__i", "__j"]).drop("__i", "__j")
    return left.join(hot, "__k", "left_anti").join(right, "__k").unionByName(met).drop("__k")


def duplicate_ids(df: DataFrame, ident: Column | str, name: str = "n") -> DataFrame:
    """AG8: ids that occur more than once."""
    return df.groupBy(ident).agg(F.count("*").alias(name)).filter(F.col(name) > 1)


def unreachable(files: DataFrame, links: DataFrame, path: str, href: str) -> DataFrame:
    """JN17: files that no link leads to (links without their ?query and #place)."""
    return dangling(files, links.withColumn(href, F.regexp_replace(href, "[?#].*$", "")), path, href)


def reconcile(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """JN5: every key of two tables as `both`, `left only`, `right only` or `case repaired`.

    A key without a partner is repaired if just one left and one right key are equal in lower case."""
    a, b = left.select(key).distinct(), right.select(F.col(key).alias("__r")).distinct()
    full = a.join(b, F.col(key) == F.col("__r"), "full_outer")
    lone_a = full.filter("__r IS NULL").select(F.col(key).alias("l"), F.lower(F.col(key).cast("string")).alias("f"))
    lone_b = full.filter(F.col(key).isNull()).select(F.col("__r").alias("r"), F.lower(F.col("__r").cast("string")).alias("f"))
    one_a = lone_a.groupBy("f").agg(F.max("l").alias("l"), F.count("*").alias("n")).filter("n = 1").drop("n")
    one_b = lone_b.groupBy("f").agg(F.max("r").alias("r"), F.count("*").alias("n")).filter("n = 1").drop("n")
    fixed = one_a.join(one_b, "f").select("l", "r")
    both = full.filter(F.col(key).isNotNull() & F.col("__r").isNotNull()).select(F.col(key).alias("left_key"), F.col("__r").alias("right_key"), F.lit("both").alias("status"))
    rest_a = lone_a.join(fixed, "l", "left_anti").select(F.col("l").alias("left_key"), F.lit(None).cast(left.schema[key].dataType).alias("right_key"), F.lit("left only").alias("status"))
    rest_b = lone_b.join(fixed, "r", "left_anti").select(F.lit(None).cast(left.schema[key].dataType).alias("left_key"), F.col("r").alias("right_key"), F.lit("right only").alias("status"))
    return both.unionByName(rest_a).unionByName(rest_b).unionByName(fixed.select(F.col("l").alias("left_key"), F.col("r").alias("right_key"), F.lit("case repaired").alias("status")))


def link_status(links: DataFrame, books: DataFrame, verses: DataFrame, book: str, verse: str) -> DataFrame:
    """JN4: links to a book that is not there are external, to a verse that is not there errors, others fine."""
    b = books.select(F.col(book).alias("__b")).distinct().withColumn("__hb", F.lit(True))
    v = verses.select(F.col(verse).alias("__v")).distinct().withColumn("__hv", F.lit(True))
    out = links.join(b, F.col(book) == F.col("__b"), "left").join(v, F.col(verse) == F.col("__v"), "left")
    return out.withColumn("status", F.when(F.col("__hb").isNull(), "external").when(F.col("__hv").isNull(), "error").otherwise("ok")).drop("__b", "__v", "__hb", "__hv")


def circular(links: DataFrame, source: str, target: str, short: Column) -> DataFrame:
    """JN16: entries that are short, link to just one other, and are linked back by it."""
    each = links.filter(F.col(source) != F.col(target)).select(source, target).distinct()
    single = links.filter(short).select(source, target).distinct().groupBy(source).agg(F.min(target).alias(target), F.count("*").alias("n")).filter("n = 1").drop("n")
    back = each.select(F.col(source).alias(target), F.col(target).alias(source))
    return single.join(back, [source, target], "left_semi")


def duplicates_by_key(df: DataFrame, key: Column, order: Sequence[str]) -> DataFrame:
    """AG7: the 1-based place of each row among those with an equal key (lower case, white space squeezed), the group's
    size, and the id `<first form>.dupN`, or the plain form if the key is single."""
    k = df.withColumn("dup_key", F.lower(F.trim(F.regexp_replace(key, "\\s+", " ")))).withColumn("__form", key)
    w = Window.partitionBy("dup_key")
    o = w.orderBy(*order)
    out = k.withColumn("dup_index", F.row_number().over(o)).withColumn("dup_count", F.count("*").over(w)).withColumn("__first", F.first("__form").over(o))
    return out.withColumn("entry_id", F.when(F.col("dup_count") == 1, F.col("__form")).otherwise(F.concat(F.col("__first"), F.lit(".dup"), F.col("dup_index").cast("string")))).drop("__form", "__first")


def in_context(atoms: DataFrame, sets: DataFrame, rule: str) -> DataFrame:
    """JN9: atoms (column atom) that a rule's set admits: the set has `all`, the atom, or the atom's book.

    The OR is split into equi-joins. sets: (rule, value). Result: atoms' columns and rule, distinct."""
    every = atoms.crossJoin(sets.filter(F.lower("value") == "all").select(rule).distinct())
    exact = atoms.join(sets.select(rule, F.col("value").alias("__v")), F.col("atom") == F.col("__v")).drop("__v")
    book = atoms.join(sets.select(rule, F.col("value").alias("__v")), F.substring_index("atom", ".", 1) == F.col("__v")).drop("__v")
    return every.unionByName(exact).unionByName(book).distinct()


def overlay(layers: DataFrame, keys: Sequence[str], priority: str, value: str) -> DataFrame:
    """AG9: for each key the value of the layer with the smallest priority number; `false` becomes the empty text."""
    best = layers.groupBy(*keys).agg(F.min_by(value, priority).alias(value))
    return best.withColumn(value, F.when(F.lower(value) == "false", "").otherwise(F.col(value)))


def inherit(df: DataFrame, node: str, depth: str, positive: str, negative: str) -> DataFrame:
    """AG10: attributes along the ancestors, outermost first: positives add up, and each clears the negatives so far."""
    rows = df.groupBy(node).agg(F.array_sort(F.collect_list(F.struct(depth, positive, negative))).alias("path"))
    start = F.struct(F.array().cast("array<string>").alias("pos"), F.array().cast("array<string>").alias("neg"))

    def step(acc: Column, x: Column) -> Column:
        has, no = x[positive].isNotNull(), x[negative].isNotNull()
        base = F.when(has, F.array().cast("array<string>")).otherwise(acc["neg"])
        return F.struct(F.when(has, F.concat(acc["pos"], F.array(x[positive]))).otherwise(acc["pos"]).alias("pos"), F.when(no, F.concat(base, F.array(x[negative]))).otherwise(base).alias("neg"))

    done = F.aggregate("path", start, step)
    return rows.select(node, F.array_join(done["pos"], " ").alias(positive), F.array_join(done["neg"], " ").alias(negative))


def disposition(links: DataFrame, kept: DataFrame, full: DataFrame, book: str, redirect: bool) -> DataFrame:
    """keep a link to a book of the pruned set; otherwise delete a cross-reference that is external or mere digits,
    redirect what the full set has, unlink the rest. links: kind (xref, sref, nref), external, text."""
    k = kept.select(F.col(book).alias("__k")).distinct().withColumn("__hk", F.lit(True))
    f = full.select(F.col(book).alias("__f")).distinct().withColumn("__hf", F.lit(True))
    out = links.join(k, F.col(book) == F.col("__k"), "left").join(f, F.col(book) == F.col("__f"), "left")
    mere = F.col("external") | F.col("text").rlike("^[\\d,\\s]*$")
    action = F.when(F.col("__hk"), "keep").when((F.col("kind") == "xref") & mere, "delete").when((F.col("kind") != "nref") & F.lit(redirect) & F.col("__hf"), "redirect").otherwise("unlink")
    return out.withColumn("action", action).drop("__k", "__hk", "__f", "__hf")


def keep_targets(df: DataFrame, key: str, refs: Column, allowed: DataFrame, target: str) -> DataFrame:
    """list-valued references cut down to allowed targets, in order; an empty list is marked as an error."""
    parts = df.select(key, F.posexplode_outer(F.filter(F.split(refs, "\\s+"), lambda x: x != "")).alias("pos", "part"))
    ok = allowed.select(F.col(target).alias("part")).distinct().withColumn("__ok", F.lit(True))
    back = parts.join(ok, "part", "left").groupBy(key).agg(F.array_sort(F.collect_list(F.when(F.col("__ok"), F.struct("pos", "part")))).alias("left"), F.count("part").alias("n_before"))
    out = back.select(key, F.array_join(F.transform("left", lambda x: x["part"]), " ").alias("refs"), F.size("left").cast("long").alias("n_after"), "n_before")
    return out.withColumn("is_empty", F.col("n_after") == 0)


def conversion_filter(nodes: DataFrame, marks: Column, negative: Column, wanted: Sequence[str]) -> DataFrame:
    """subtrees whose marks exist and share nothing with the wanted set go, and those whose negative marks share
    something. nodes: work, pre, post; an ancestor covers pre..post."""
    want = F.array(*map(F.lit, wanted))
    gone = nodes.withColumn("__gone", ((F.size(marks) > 0) & ~F.arrays_overlap(marks, want)) | F.arrays_overlap(negative, want))
    # open subtrees cover their descendants: the largest end among dropped rows at or before a row
    w = Window.partitionBy("work").orderBy("pre").rowsBetween(Window.unboundedPreceding, 0)
    reach = F.max(F.when(F.col("__gone"), F.col("post"))).over(w)
    return gone.withColumn("__reach", reach).filter(F.col("__reach").isNull() | (F.col("pre") > F.col("__reach"))).drop("__gone", "__reach")


def ancestors(nodes: DataFrame, low: Column, high: Column) -> DataFrame:
    """JN12: (ancestor, descendant) pairs of marked nodes within a work and book. A node's descendants are the range pre + 1 .. post,
    so the pairs come from an equi-join on the blocks of these ranges: a node meets its own descendants only."""
    a = nodes.filter(low).select("work", "book", F.col("pre").alias("a_pre"), F.col("post").alias("a_post"), (F.col("pre") + 1).alias("__low"))
    d = nodes.filter(high).select("work", "book", F.col("pre").alias("d_pre"))
    return in_range(d, a, "d_pre", "__low", "a_post", ["work", "book"]).select("work", "book", "a_pre", "a_post", "d_pre")


def substitutions(df: DataFrame, text: str, rules: Sequence[tuple[str, str]]) -> tuple[DataFrame, DataFrame]:
    """rules (pattern, replacement) applied in order, with hit counts. Gives the rows with `text` rewritten, and a
    table (rule, pattern, hits, applied) in which a rule that never matched has applied false."""
    counts, cur = [], F.col(text)
    for pattern, new in rules:
        counts.append(F.regexp_count(cur, F.lit(pattern)).cast("long"))
        cur = F.regexp_replace(cur, pattern, new)
    hits = df.select(*(c.alias(f"r{i}") for i, c in enumerate(counts)))
    total = hits.agg(*(F.sum(f"r{i}").alias(f"r{i}") for i in range(len(rules))))
    rows = total.select(F.explode(F.array(*(F.struct(F.lit(i).alias("rule"), F.lit(p).alias("pattern"), F.coalesce(F.col(f"r{i}"), F.lit(0)).alias("hits")) for i, (p, _) in enumerate(rules)))).alias("x")).select("x.*")
    return df.withColumn(text, cur), rows.withColumn("applied", F.col("hits") > 0)


def demote_findings(findings: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """findings whose message matches a pattern become notes."""
    hit = F.lit(False)
    for p in patterns:
        hit = hit | F.col("message").rlike(p)
    return findings.withColumn("severity", F.when(hit, "NOTE").otherwise(F.col("severity")))


def figure_findings(figures: DataFrame) -> DataFrame:
    """DQ4: figures (path, exists, size, w, h, kind) with a problem, and its severity."""
    finding = (
        F.when(~F.col("exists"), F.struct(F.lit("ERROR").alias("severity"), F.lit("missing").alias("finding")))
        .when(~F.lower(F.substring_index("path", ".", -1)).isin("jpg", "jpeg", "png", "gif"), F.struct(F.lit("ERROR").alias("severity"), F.lit("extension").alias("finding")))
        .when(F.col("size") > 400_000, F.struct(F.lit("ERROR").alias("severity"), F.lit("size").alias("finding")))
        .when(F.col("size") > 250_000, F.struct(F.lit("WARNING").alias("severity"), F.lit("size").alias("finding")))
        .when(F.col("w") + F.col("h") > 3000, F.struct(F.lit("WARNING").alias("severity"), F.lit("dimensions").alias("finding")))
    )
    return figures.withColumn("f", finding).filter("f IS NOT NULL").select("path", "f.severity", "f.finding")


def name_findings(conf: DataFrame, names: str, required: Sequence[str]) -> DataFrame:
    """DQ9: entries whose name does not match the allowed pattern, and required ones that are missing."""
    bad = conf.filter(~F.col("entry").rlike(names)).select("section", "entry", F.lit("unknown name").alias("finding"))
    need = conf.sparkSession.createDataFrame([(r,) for r in required], "entry string")
    return bad.unionByName(need.join(conf, "entry", "left_anti").select(F.lit(None).cast("string").alias("section"), "entry", F.lit("missing").alias("finding")))


def oversize(df: DataFrame, key: str, text: str, most: int = 64_000) -> DataFrame:
    """DQ12: groups whose texts add up to more than `most` characters."""
    return df.groupBy(key).agg(F.sum(F.length(text)).alias("n_chars")).filter(F.col("n_chars") > most)


def expected_counts(df: DataFrame, section: str, expected: Sequence[tuple[str, int]]) -> DataFrame:
    """DQ8: sections whose number of rows is not the expected one (0 if a section is missing)."""
    want = df.sparkSession.createDataFrame([*expected], f"{section} string, expected long")
    have = df.groupBy(section).agg(F.count("*").alias("seen"))
    return want.join(have, section, "left").withColumn("seen", F.coalesce("seen", F.lit(0))).filter("seen <> expected")
