"""Scalar text functions as column expressions."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Code points above this are encoded; a parameter because it belongs to a script, not to the method.
MAX_UNICODE = 1103
_PLAIN = "\\p{L}\\p{N}"


def code_points(s: Column) -> Column:
    """The characters of a string, one code point each."""
    return F.filter(F.split(s, ""), lambda c: c != "")


def encode_ref(s: Column, highest: int = MAX_UNICODE) -> Column:
    """SF1: characters that are no letter or digit, or above `highest`, become _N_ (N: the code point). `_` is always encoded."""

    def one(c: Column) -> Column:
        point = code_point(c)
        return F.when(c.rlike(f"^[{_PLAIN}]$") & (point <= highest), c).otherwise(F.concat(F.lit("_"), point.cast("string"), F.lit("_")))

    return F.array_join(F.transform(code_points(s), one), "")


def code_point(c: Column) -> Column:
    """The code point of a one-character string, from its UTF-32 bytes."""
    return F.conv(F.hex(F.encode(c, "UTF-32")), 16, 10).cast("int")


def decode_ref(s: Column) -> Column:
    """SF2: _N_ back to characters, in one pass from the left (the built-in char() is modulo 256)."""

    @F.pandas_udf("string")
    def run(t: pd.Series) -> pd.Series:
        return t.map(lambda x: None if x is None else re.sub(r"_(\d+)_", lambda m: chr(int(m[1])) if int(m[1]) < 0x110000 else m[0], x))

    return run(s)


def split_ref(ref: Column) -> tuple[Column, Column]:
    """SF3: work prefix (null if none) and the rest of `work:rest`."""
    has = F.instr(ref, ":") > 0
    return F.when(has, F.substring_index(ref, ":", 1)), F.when(has, F.regexp_replace(ref, "^[^:]*:", "")).otherwise(ref)


def xml_id(s: Column) -> Column:
    """SF4: a valid XML id: other characters become their code point in x.., a leading non-letter is prefixed by `id_`."""
    body = F.array_join(F.transform(code_points(s), lambda c: F.when(c.rlike("^[A-Za-z0-9_.-]$"), c).otherwise(F.concat(F.lit("x"), code_point(c).cast("string")))), "")
    return F.when(body.rlike("^[A-Za-z_]"), body).otherwise(F.concat(F.lit("id_"), body))


def upper_with(s: Column, pairs: list[tuple[str, str]] = ()) -> Column:
    """SF5: upper case, special (lower, upper) pairs first."""
    for low, up in pairs:
        s = F.replace(s, F.lit(low), F.lit(up))
    return F.upper(s)


def lower_with(s: Column, pairs: list[tuple[str, str]] = ()) -> Column:
    for low, up in pairs:
        s = F.replace(s, F.lit(up), F.lit(low))
    return F.lower(s)


def title_case(s: Column, mode: int = 1) -> Column:
    """SF6: 0 as it is, 1 first letters of words, 2 first letter of the text, 3 all capitals. Bracketed prefixes are dropped
    and Roman numerals stay capitals."""
    bare = F.regexp_replace(s, "^(\\[[^\\]]*\\])+", "")
    if mode == 0:
        return bare
    if mode == 3:
        return F.upper(bare)
    capital = lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 30)))
    if mode == 2:
        return capital(bare)
    words = F.transform(F.split(bare, " "), lambda w: F.when(w.rlike("^[IVXLCDM]+\\.?$"), w).otherwise(capital(w)))
    return F.array_join(words, " ")


def instructions(title: Column) -> tuple[Column, Column]:
    """SF7: the bracketed instructions in front of a title, and the title."""
    head = F.regexp_extract(title, "^((?:\\[[^\\]]*\\])*)", 1)
    return F.regexp_extract_all(head, F.lit("\\[([^\\]]*)\\]"), F.lit(1)), F.substring(title, F.length(head) + 1, F.length(title))


def normalise(form: str):  # noqa: ANN201
    """SF8: Unicode normal form NFC, NFD, NFKC or NFKD as a column function."""
    if form not in ("NFC", "NFD", "NFKC", "NFKD"):
        raise ValueError(form)

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else unicodedata.normalize(form, x))

    return run


def squeeze(s: Column) -> Column:
    """SF9: white space runs become one space, ends are trimmed, an escaped line feed (backslash n) stays."""
    return F.trim(F.regexp_replace(s, "\\s+", " "))


def short_md5(s: Column) -> Column:
    """SF10: four hexadecimal digits of the MD5."""
    return F.substring(F.md5(s), 1, 4)


def attributes(s: Column, default: str = "lemma") -> tuple[Column, Column]:
    """SF11: `text|a="x" b="y"` to (text, map); a bare value belongs to the default attribute."""
    text = F.substring_index(s, "|", 1)
    rest = F.when(F.instr(s, "|") > 0, F.regexp_replace(s, "^[^|]*\\|", "")).otherwise("")
    keys = F.regexp_extract_all(rest, F.lit('([\\w-]+)="([^"]*)"'), F.lit(1))
    values = F.regexp_extract_all(rest, F.lit('([\\w-]+)="([^"]*)"'), F.lit(2))
    named = F.map_from_arrays(F.array_distinct(keys), F.transform(F.array_distinct(keys), lambda k: F.element_at(values, F.array_position(keys, k).cast("int"))))
    bare = F.map_from_arrays(F.array(F.lit(default)), F.array(F.trim(rest)))
    return text, F.when(F.size(keys) > 0, named).when(F.trim(rest) != "", bare).otherwise(F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))


def camel(s: Column) -> Column:
    """SF12: dashed-name to dashedName."""
    parts = F.split(s, "-")
    return F.concat(F.element_at(parts, 1), F.array_join(F.transform(F.slice(parts, 2, 1 << 20), lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 30))), ""))


def local_reference(names: Column, start: Column, end: Column, separators: tuple[str, str] = (":", "-")) -> Column:
    """SF13: (book, ch, vs) structs to `Name 1:2-3`; what both ends share is not repeated, a whole chapter has no verse."""
    cv, dash = separators
    one = lambda x: F.concat(x["ch"].cast("string"), F.coalesce(F.concat(F.lit(cv), x["vs"].cast("string")), F.lit("")))
    tail = F.when(end.isNull() | ((end["ch"] == start["ch"]) & (end["vs"].eqNullSafe(start["vs"]))), F.lit("")).when(
        end["ch"] == start["ch"], F.concat(F.lit(dash), end["vs"].cast("string"))
    ).otherwise(F.concat(F.lit(dash), one(end)))
    return F.concat(names, F.lit(" "), one(start), tail)


def root_id(ref: Column) -> Column:
    """SF14: an entry's root: no work, no `.dupN`, lower case."""
    return F.lower(F.regexp_replace(split_ref(ref)[1], "\\.dup\\d+$", ""))


def valid_range(book: Column, ch: Column, vs: Column, last: Column) -> Column:
    """SF16: a verse range within one chapter whose end, if any, is beyond its start."""
    return book.isNotNull() & (ch > 0) & (vs.isNull() | (vs >= 0)) & (last.isNull() | (last > vs))


def replace_table(s: Column, table: list[tuple[str, str]]) -> Column:
    """SF18/SF19 fast: literals replaced one after another; each replacement sees the one before."""
    for old, new in table:
        s = F.replace(s, F.lit(old), F.lit(new))
    return s


def replace_once(table: list[tuple[str, str]]):  # noqa: ANN201
    """SF19 strict: one pass from the left, the longest literal first, results are not looked at again."""
    known = dict(reversed(table))
    pattern = re.compile("|".join(map(re.escape, sorted(known, key=len, reverse=True))) or r"(?!)")

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else pattern.sub(lambda m: known[m[0]], x))

    return run


def simplify(s: Column, singles: tuple[str, str], longer: list[tuple[str, str]] = ()) -> Column:
    """SF20: characters for limited devices: one for one, then by longer replacements."""
    return replace_table(F.translate(s, *singles), list(longer))


def relative_path(source: Column, target: Column) -> Column:
    """SF22: the path from one file to another; within one file only the fragment."""
    a, b = F.split(source, "/"), F.split(F.substring_index(target, "#", 1), "/")
    fragment = F.when(F.instr(target, "#") > 0, F.concat(F.lit("#"), F.substring_index(target, "#", -1))).otherwise("")
    steps = F.sequence(F.lit(1), F.greatest(F.least(F.size(a), F.size(b)), F.lit(1)))
    # steps that agree from the front, the file names left out
    same = F.aggregate(steps, F.lit(0), lambda n, i: F.when((n == i - 1) & (i < F.size(a)) & (i < F.size(b)) & F.get(a, i - 1).eqNullSafe(F.get(b, i - 1)), i).otherwise(n))
    up = F.array_repeat(F.lit(".."), F.size(a) - 1 - same)
    down = F.slice(b, same + 1, F.size(b))
    return F.when(F.array_join(a, "/") == F.array_join(b, "/"), fragment).otherwise(F.concat(F.array_join(F.concat(up, down), "/"), fragment))


def shorten_path(path: Column) -> Column:
    """SF29: `a/../b` becomes `b`, up to eight levels."""
    for _ in range(8):
        path = F.regexp_replace(path, "(^|/)(?!\\.\\./)[^/]+/\\.\\./", "$1")
    return path


def escape_file_name(s: Column) -> Column:
    """SF29: `<>:"|` as %N (N: the code point in decimal)."""
    for c in '<>:"|':
        s = F.replace(s, F.lit(c), F.lit(f"%{ord(c)}"))
    return s


def unescape_file_name(s: Column) -> Column:
    for c in '<>:"|':
        s = F.replace(s, F.lit(f"%{ord(c)}"), F.lit(c))
    return s


def escape_attribute(s: Column) -> Column:
    """SF29: characters that mean something in an attribute as &#N;."""
    s = F.replace(s, F.lit("&"), F.lit("&#38;"))
    for c in "<>\"'":
        s = F.replace(s, F.lit(c), F.lit(f"&#{ord(c)};"))
    return s


def atoms(ref: Column) -> Column:
    """SF23: the ends of every range of a reference, in order."""
    return F.flatten(F.transform(F.filter(F.split(ref, "\\s+"), lambda x: x != ""), lambda x: F.split(x, "-")))


def css_class(*parts: Column) -> Column:
    """SF24: class names joined by spaces, without those that are null or empty."""
    return F.array_join(F.array_distinct(F.filter(F.array(*parts), lambda p: p.isNotNull() & (p != ""))), " ")


#: Ordinal words and their numbers.
ORDINALS = {"first": 1, "second": 2, "third": 3, "fourth": 4, "fifth": 5, "sixth": 6, "seventh": 7, "eighth": 8, "ninth": 9, "tenth": 10, "last": -1}


def ordinal(word: Column, extra: dict[str, int] | None = None) -> Column:
    """SF25: an ordinal word's number; -1 is the last one, null an unknown word."""
    pairs = [x for k, v in (ORDINALS | (extra or {})).items() for x in (F.lit(k), F.lit(v))]
    return F.element_at(F.create_map(*pairs), F.lower(word))


def alternation(terms: list[str], longest_first: bool = True) -> str:
    """SF26/UX6: a Java pattern that matches any of the terms."""
    return "|".join(f"\\Q{t}\\E" for t in sorted(set(terms), key=lambda t: (-len(t) if longest_first else len(t), t)))


def is_utf8(data: Column) -> Column:
    """SF28: whether bytes are valid UTF-8."""
    return F.is_valid_utf8(data.cast("string"))


def protect(s: Column, pattern: str) -> Column:
    """AN5: every match of pattern as `{{{a_b}}}`, its spaces written as underscores, so that later patterns pass it over."""
    found = F.regexp_extract_all(s, F.lit(pattern), F.lit(0))
    kept = F.transform(found, lambda x: F.concat(F.lit("{{{"), F.replace(x, F.lit(" "), F.lit("_")), F.lit("}}}")))
    parts = F.arrays_zip(F.split(s, pattern, -1).alias("gap"), kept.alias("kept"))
    return F.array_join(F.transform(parts, lambda p: F.concat(p["gap"], F.coalesce(p["kept"], F.lit("")))), "")


def unprotect(s: Column) -> Column:
    """AN5: the texts that protect() hid, as they were (a match must have no underscore of its own)."""
    shape = "\\{\\{\\{[^{}]*\\}\\}\\}"
    kept = F.transform(F.regexp_extract_all(s, F.lit(shape), F.lit(0)), lambda x: F.replace(F.regexp_replace(x, "[{}]", ""), F.lit("_"), F.lit(" ")))
    parts = F.arrays_zip(F.split(s, shape, -1).alias("gap"), kept.alias("kept"))
    return F.array_join(F.transform(parts, lambda p: F.concat(p["gap"], F.coalesce(p["kept"], F.lit("")))), "")


def context_sample(text: Column, link: Column, longest: int = 256) -> Column:
    """AN12: the text around a link, the link marked by stars, white space squeezed, one sentence if it is longer than allowed."""
    marked = squeeze(F.replace(text, link, F.concat(F.lit("*"), link, F.lit("*"))))
    sentence = F.element_at(F.filter(F.split(marked, "(?<=[.!?])\\s+"), lambda x: F.contains(x, F.concat(F.lit("*"), link, F.lit("*")))), 1)
    return F.when(F.length(marked) > longest, F.coalesce(sentence, marked)).otherwise(marked)


def sort_key(s: Column, letters: list[str], ignored: str = "[^\\p{L}\\p{N} ]") -> Column:
    """ST2: a key whose code-point order is the collation. letters: in order, several characters may be one letter.
    Upper case is folded, what `ignored` matches is dropped, longer letters match first, a letter becomes char(place + 64)
    and other characters stay."""
    key = F.regexp_replace(F.upper(s), ignored, "")
    places = {}
    for i, x in enumerate(letters):
        places.setdefault(x.upper(), i)
    for x in sorted(places, key=lambda x: (-len(x), places[x])):
        # private-use stand-ins keep a replaced letter from being replaced again
        key = F.replace(key, F.lit(x), F.lit(chr(0xE000 + places[x])))
    return F.translate(key, "".join(chr(0xE000 + i) for i in sorted(places.values())), "".join(chr(i + 65) for i in sorted(places.values())))


def lead_letter(s: Column, letters: list[str]) -> Column:
    """ST3: the letter of the alphabet with which a text begins."""
    up = F.upper(s)
    out = F.substring(up, 1, 1)
    for x in sorted(set(letters), key=len):
        out = F.when(F.startswith(up, F.lit(x.upper())), F.lit(x.upper())).otherwise(out)
    return out


