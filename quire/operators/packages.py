"""Packages: zip archives, module settings, and what phone collections need, as DataFrames."""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import replace_table

#: Fixed values of the zip format: from here on a field of four or two bytes is all ones, and the long form says the number.
MOST4, MOST2 = 0xFFFFFFFF, 0xFFFF
#: What phones show badly, and what stands for it.
PHONE = [("…", "..."), ("\u00ad", "")]


def _deflate(content: Column) -> Column:
    @F.pandas_udf("binary")
    def run(rows: pd.Series) -> pd.Series:
        def one(data: bytes) -> bytes:
            packer = zlib.compressobj(wbits=-15)
            return packer.compress(data) + packer.flush()

        return rows.map(one)

    return run(content)


def _field(n: Column | int, width: int) -> Column:
    """A number in so many bytes, the lowest first, in hex."""
    if isinstance(n, int):
        return F.lit(n.to_bytes(width, "little").hex())
    digits = F.lpad(F.hex(n.cast("long")), 2 * width, "0")
    return F.concat(*(F.substring(digits, 2 * k + 1, 2) for k in reversed(range(width))))


def _short(n: Column, most: int, width: int) -> Column:
    return F.when(n >= most, (1 << 8 * width) - 1).otherwise(n)


def _record(*fields: tuple[Column | int, int]) -> Column:
    return F.unhex(F.concat(*(_field(n, width) for n, width in fields)))


def zip_parts(files: DataFrame, package: str, name: str, content: str) -> DataFrame:
    """SK4/SK7: zip archives in parts (package, kind, seq, bytes): files (0), directory entries (1), end (2), which behind one another
    in order of kind and seq are the package's archive.

    A file is packed where it stands, and places in the archive are running sums of lengths, so no task holds a package. Files are
    in order of their names, with one fixed date: equal files give equal archives. Rows without a package or name are no files;
    null content is empty; a name may repeat. Long archives take the long form of the directory."""
    w = Window.partitionBy("package").orderBy("name", "crc", "size")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    f = files.select(F.col(package).alias("package"), F.encode(name, "UTF-8").alias("name"), F.coalesce(F.col(content), F.lit(b"")).alias("content")).filter("package IS NOT NULL AND name IS NOT NULL")
    f = f.select("package", "name", F.crc32("content").alias("crc"), F.length("content").alias("size"), _deflate(F.col("content")).alias("packed"))
    # flags: names in UTF-8; method: deflate; date: 1980-01-01
    facts = [(0x0800, 2), (8, 2), (0, 2), (0x0021, 2), (F.col("crc"), 4), (F.length("packed"), 4), (F.col("size"), 4), (F.length("name"), 2)]
    f = f.withColumn("local", F.concat(_record((0x04034B50, 4), (20, 2), *facts, (0, 2)), "name", "packed"))
    f = f.withColumn("seq", F.row_number().over(w)).withColumn("at", F.coalesce(F.sum(F.length("local")).over(before), F.lit(0)))
    far = F.col("at") >= MOST4
    entry = _record((0x02014B50, 4), (45, 2), (45, 2), *facts, (F.when(far, 12).otherwise(0), 2), (0, 2), (0, 2), (0, 2), (0, 4), (_short(F.col("at"), MOST4, 4), 4))
    place = F.when(far, _record((1, 2), (8, 2), (F.col("at"), 8))).otherwise(F.lit(b""))
    f = f.withColumn("entry", F.concat(entry, "name", place))
    f = f.withColumn("listed", F.sum(F.length("entry")).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("is_last", F.lead("seq").over(w).isNull())
    n, start, listed = F.col("seq"), F.col("at") + F.length("local"), F.col("listed")
    long_end = F.concat(_record((0x06064B50, 4), (44, 8), (45, 2), (45, 2), (0, 4), (0, 4), (n, 8), (n, 8), (listed, 8), (start, 8)), _record((0x07064B50, 4), (0, 4), (start + listed, 8), (1, 4)))
    long_end = F.when((n >= MOST2) | (start >= MOST4) | (listed >= MOST4), long_end).otherwise(F.lit(b""))
    end = _record((0x06054B50, 4), (0, 2), (0, 2), *[(_short(n, MOST2, 2), 2)] * 2, (_short(listed, MOST4, 4), 4), (_short(start, MOST4, 4), 4), (0, 2))
    parts = [F.struct(F.lit(0).alias("kind"), F.col("local").alias("bytes")), F.struct(F.lit(1).alias("kind"), F.col("entry").alias("bytes"))]
    parts.append(F.when(F.col("is_last"), F.struct(F.lit(2).alias("kind"), F.concat(long_end, end).alias("bytes"))))
    return f.select("package", "seq", F.explode(F.array(*parts)).alias("x")).filter("x IS NOT NULL").select("package", "x.kind", "seq", "x.bytes")


def archives(parts: DataFrame) -> DataFrame:
    """SK4/SK7: (package, archive) of parts, for archives that fit a row (under 1 GB); longer ones are written part by part."""
    rows = F.array_sort(F.collect_list(F.struct("kind", "seq", "bytes")))
    return parts.groupBy("package").agg(F.unhex(F.array_join(F.transform(rows, lambda x: F.hex(x["bytes"])), "")).alias("archive"))


def unzipped(packages: DataFrame, package: str = "package", archive: str = "archive") -> DataFrame:
    """SK4/SK7: the files of archives: (package, name, content), one file in memory at a time; directories and null archives have none."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for key, data in zip(frame["package"], frame["archive"], strict=True):
                with zipfile.ZipFile(io.BytesIO(data)) as z:
                    for info in z.infolist():
                        if not info.is_dir():
                            yield pd.DataFrame({"package": [key], "name": [info.filename], "content": [z.read(info)]})

    kind = packages.schema[package].dataType.simpleString()
    rows = packages.select(F.col(package).alias("package"), F.col(archive).alias("archive")).filter("archive IS NOT NULL")
    return rows.mapInPandas(read, f"package {kind}, name string, content binary")


def module_settings(own: DataFrame, derived: DataFrame, multiple: Sequence[str]) -> DataFrame:
    """SK7: a module's settings: its own (work, entry, seq, value), then the derived ones, empty ones left out. An entry that may have
    several values takes both; any other keeps its own, and the derived value becomes a finding."""
    both = own.withColumn("__d", F.lit(False)).unionByName(derived.filter("value <> ''").withColumn("__d", F.lit(True)))
    w = Window.partitionBy("work", "entry").orderBy("__d", "seq", "value")
    place = (F.row_number().over(w) - 1).alias("seq")
    lost = F.col("__d") & (F.col("seq") > 0) & ~F.col("entry").isin(*multiple)
    return both.select("work", "entry", place, "value", "__d").withColumn("finding", F.when(lost, "several values")).drop("__d")


def install_facts(files: DataFrame) -> DataFrame:
    """SK7: settings derived from a module's files (work, path, size): how large they are, and whether there are images."""
    one = files.groupBy("work").agg(F.sum("size").cast("string").alias("InstallSize"), F.max(F.when(F.lower("path").rlike("\\.(png|gif|jpe?g)$"), "Images")).alias("Feature"))
    return one.unpivot("work", ["InstallSize", "Feature"], "entry", "value").filter("value IS NOT NULL").select("work", "entry", F.lit(0).alias("seq"), "value")


def phone_text(s: Column, table: list[tuple[str, str]]) -> Column:
    """SK8: a text in a variant's characters: what phones show badly is replaced, then the variant's table in its order."""
    return replace_table(s, [*PHONE, *table])


def high_chars(texts: DataFrame, key: str, text: str, highest: int) -> DataFrame:
    """SK8: characters above a code point, how often they are there and the first key that has them; for a simple variant each is a
    finding. Only such characters leave a text, and UTF-8 sorts as code points do."""
    high = F.filter(F.split(text, ""), lambda c: c > F.lit(chr(highest)))
    return texts.select(F.col(key).alias("key"), F.explode(high).alias("ch")).groupBy("ch").agg(F.count("*").alias("n"), F.min("key").alias("first"))


def collection_files(books: DataFrame) -> DataFrame:
    """SK8: the file that tells a phone application's collections: the books' names by book, then each collection with its books in order.
    books: app, collection, place, book, name (null: not told)."""
    line = F.when(F.col("name").isNotNull(), F.concat(F.lit("Book-Name-Map: "), "book", F.lit(", "), "name", F.lit("\n")))
    told = F.array_join(F.array_sort(F.collect_set(line)), "")
    kept = books.groupBy("app", "collection").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "book"))), lambda x: F.concat(F.lit("Book: "), x["book"], F.lit("\n"))), "").alias("x"))
    body = kept.groupBy("app").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("collection", "x"))), lambda c: F.concat(F.lit("\nCollection: "), c["collection"], F.lit("\n"), c["x"])), "").alias("body"))
    return books.groupBy("app").agg(told.alias("names")).join(body, "app").select("app", F.concat("names", "body").alias("text"))
