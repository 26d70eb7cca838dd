"""Archives, module settings and phone collections."""

import io
import zipfile

import pytest

from quire.operators import packages

FILES = [(1, "b.txt", b"second"), (1, "a/ä.txt", "größer".encode() * 99), (1, "c", None), (1, "c", b""), (1, "c", b"x"), (2, "", b"unnamed"), (2, "n", b"\0" * 70000), (None, "x", b"y"), (3, None, b"z")]
SCHEMA = "p long, n string, c binary"


def archives_of(spark, rows):
    return {r.package: bytes(r.archive) for r in packages.archives(packages.zip_parts(spark.createDataFrame(rows, SCHEMA), "p", "n", "c")).collect()}


@pytest.mark.parametrize("most", [(0xFFFFFFFF, 0xFFFF), (60, 2)])
def test_archives_are_read_by_the_library(spark, monkeypatch, most):
    monkeypatch.setattr(packages, "MOST4", most[0])
    monkeypatch.setattr(packages, "MOST2", most[1])
    got = archives_of(spark, FILES)
    assert sorted(got) == [1, 2]
    for key, data in got.items():
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            assert z.testzip() is None
            read = sorted((i.filename, z.read(i)) for i in z.infolist())
        assert read == sorted((n, c or b"") for p, n, c in FILES if p == key and n is not None)


def test_equal_files_give_equal_archives(spark):
    assert archives_of(spark, FILES) == archives_of(spark, FILES[::-1])


def test_empty_tables_and_other_archives(spark):
    assert archives_of(spark, []) == {}
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.mkdir("d")
        z.writestr("d/e", "plain")
    rows = spark.createDataFrame([("k", out.getvalue()), ("none", None)], "package string, archive binary")
    assert [tuple(r) for r in packages.unzipped(rows).collect()] == [("k", "d/e", b"plain")]
    assert packages.unzipped(rows.limit(0)).count() == 0


def test_module_settings(spark):
    schema = "work string, entry string, seq int, value string"
    own = spark.createDataFrame([("w", "Lang", 0, "xx"), ("w", "Feature", 0, "A"), ("w", "Feature", 1, "B")], schema)
    derived = spark.createDataFrame([("w", "Lang", 0, "yy"), ("w", "Feature", 0, "Images"), ("w", "Scope", 0, ""), ("v", "Lang", 0, "zz")], schema)
    got = sorted(tuple(r) for r in packages.module_settings(own, derived, ["Feature"]).collect())
    assert got == [
        ("v", "Lang", 0, "zz", None), ("w", "Feature", 0, "A", None), ("w", "Feature", 1, "B", None), ("w", "Feature", 2, "Images", None),
        ("w", "Lang", 0, "xx", None), ("w", "Lang", 1, "yy", "several values"),
    ]


def test_collection_files(spark):
    rows = [("app", "ot2", 3, "Exod", "Second"), ("app", "ot1", 2, "Lev", None), ("app", "ot1", 1, "Gen", "First"), ("bare", "nt", 1, "Matt", None)]
    got = {r.app: r.text for r in packages.collection_files(spark.createDataFrame(rows, "app string, collection string, place int, book string, name string")).collect()}
    assert got["app"] == "Book-Name-Map: Exod, Second\nBook-Name-Map: Gen, First\n\nCollection: ot1\nBook: Gen\nBook: Lev\n\nCollection: ot2\nBook: Exod\n"
    assert got["bare"] == "\nCollection: nt\nBook: Matt\n"


def test_phone_characters(spark):
    t = spark.createDataFrame([(1, "a…b\u00adc ъ"), (2, "ъъ😀"), (3, None), (4, "")], "k int, t string")
    assert [r.t for r in t.select(packages.phone_text(t.t, [("ъ", "y")]).alias("t")).collect()] == ["a...bc y", "yy😀", None, ""]
    assert {tuple(r) for r in packages.high_chars(t, "k", "t", 0x3FF).collect()} == {("…", 1, 1), ("ъ", 3, 1), ("😀", 1, 2)}
