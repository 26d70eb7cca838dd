"""The term linker: rule tables applied greedily to text, first per context only, and what is made from keywords."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.plans.graph import dealt


@dataclass(frozen=True)
class Rule:
    """pattern: /regex/flags; the last group or a group named link is what is linked. multiple: `false` links the first per
    context and entry, `match` the first per rule, `true` all. context/not_context: atoms or books."""

    entry: str
    ref: str
    pattern: str
    multiple: str = "false"
    context: frozenset[str] = frozenset()
    not_context: frozenset[str] = frozenset()
    only: str = ""  # OT or NT
    dont_link: bool = False


def compile_rule(pattern: str) -> re.Pattern:
    """AN9: `/regex/flags` with only the flag i, \\Q..\\E quoted, (?'name') groups."""
    m = re.fullmatch(r"\s*/(.*)/([a-z]*)\s*", pattern, re.S)
    if not m or set(m[2]) - {"i"}:
        raise ValueError(f"not a pattern: {pattern}")
    body = re.sub(r"\\Q(.*?)(?:\\E|$)", lambda q: re.escape(q[1]), m[1], flags=re.S)
    body = re.sub(r"\(\?'(\w+)'", r"(?P<\1>", body)
    return re.compile(body, re.I if "i" in m[2] else 0)


def _admitted(values: frozenset[str], atom: str | None) -> bool:
    return "all" in {v.lower() for v in values} or (atom is not None and (atom in values or atom.split(".")[0] in values))


#: Rules at most, since each task gets them all.
MOST_RULES = 1_000_000


class _Fold(dict):
    """Characters to one that stands for all that a pattern without case takes for the same."""

    def __missing__(self, point: int) -> int:
        c = chr(point)
        one = next((x for x in (c.casefold(), c.lower()) if len(x) == 1), c)
        self[point] = ord(one)
        return self[point]


FOLD = _Fold({0x130: 0x69, 0x131: 0x69})  # both dotted and dotless i


def folded(text: str) -> str:
    """The text in folded characters, as long as it was."""
    return text.lower() if text.isascii() else text.translate(FOLD)


def _plain(c: str) -> bool:
    """Whether a character's cases have one letter each."""
    return len(c.casefold()) == len(c.lower()) == len(c.upper()) == 1 or c in "iİı"


def stem(p: re.Pattern) -> str:
    """The longest folded text that each match must hold, by the parsed pattern; empty if none is sure."""
    try:
        from re import _constants as op
        from re import _parser as parser
    except ImportError:  # another Python: no stem, so the pattern is always tried
        return ""

    def parts(items: Sequence) -> Iterator[str | None]:
        """Characters that follow each other in every match; None where anything may be between."""
        for what, value in items:
            if what is op.LITERAL:
                yield chr(value)
            elif what is op.SUBPATTERN and not value[1] and not value[2]:
                yield from parts(value[3])
            elif what in (op.MAX_REPEAT, op.MIN_REPEAT) and value[0] >= 1:
                yield from (None, *parts(value[2]), None)
            elif what is not op.AT:
                yield None

    best, run = "", ""
    for c in (*parts(parser.parse(p.pattern, p.flags)), None):
        if c is not None and (not p.flags & re.I or _plain(c)):
            run += c
        else:
            best, run = max(best, run, key=len), ""
    return folded(best)


def literal(p: re.Pattern) -> bool:
    """Whether a pattern is its stem and word boundaries, no more: then each match is an occurrence of the stem, and whether there
    is one depends on the characters beside it alone."""
    try:
        from re import _constants as op
        from re import _parser as parser
    except ImportError:
        return False

    def length(items: Sequence) -> int | None:
        n = 0
        for what, value in items:
            if what is op.LITERAL and (not p.flags & re.I or _plain(chr(value))):
                n += 1
            elif what is op.SUBPATTERN and not value[1] and not value[2]:
                inner = length(value[3])
                if not inner:  # a group is linked, so none is empty
                    return None
                n += inner
            elif what is not op.AT or value not in (op.AT_BOUNDARY, op.AT_NON_BOUNDARY):
                return None
        return n

    n = length(parser.parse(p.pattern, p.flags))
    return bool(n) and n == len(stem(p))


@dataclass
class Index:
    """Rules by their stems: one pass over a text finds where the stems of all rules are, so that only rules whose stem is in a
    stretch are tried there. Rules without a stem are always tried. Patterns are compiled when they are first tried."""

    rules: list[Rule]
    stems: list[str]
    patterns: dict[int, re.Pattern] = field(default_factory=dict)
    automaton: object = None
    literals: frozenset[int] = frozenset()

    @staticmethod
    def of(rules: list[Rule]) -> "Index":
        compiled = [compile_rule(r.pattern) for r in rules]
        return Index(rules, [stem(p) for p in compiled], literals=frozenset(i for i, p in enumerate(compiled) if literal(p)))

    def __getstate__(self) -> dict:
        return {"rules": self.rules, "stems": self.stems, "patterns": {}, "automaton": None, "literals": self.literals}

    def pattern(self, i: int) -> re.Pattern:
        if i not in self.patterns:
            self.patterns[i] = compile_rule(self.rules[i].pattern)
        return self.patterns[i]

    def places(self, text: str) -> list[tuple[int, list[int] | None]]:
        """(rule, where its stem begins) of the rules that may match, in the rules' order; None for a rule without a stem."""
        if self.automaton is None:
            import ahocorasick

            by_stem: dict[str, list[int]] = {}
            for i, s in enumerate(self.stems):
                by_stem.setdefault(s, []).append(i)
            self.automaton = ahocorasick.Automaton()
            for s, which in by_stem.items():
                if s:
                    self.automaton.add_word(s, (len(s), which))
            self.automaton.make_automaton()
            self.always = by_stem.get("", [])
        found: dict[int, list[int] | None] = {i: None for i in self.always}
        if len(self.automaton):
            for end, (size, which) in self.automaton.iter(folded(text)):
                for i in which:
                    found.setdefault(i, []).append(end - size + 1)
        return sorted(found.items())


class Places:
    """Where the literal rules (see literal()) of a text may match: the first rule of a stretch without trying each. A place within a
    stretch matches there if it does in the text; places at a stretch's ends are tried, as its ends count as the text's."""

    BLOCK = 64

    def __init__(self, index: Index, text: str, found: list[tuple[int, list[int], int]]) -> None:
        self.index, self.text, self.sizes = index, text, {i: size for i, _, size in found}
        self.begin: dict[int, list[int]] = {}
        self.end: dict[int, list[int]] = {}
        self.good: dict[int, list[int]] = {}
        places = []
        for i, where, size in found:
            p, good = index.pattern(i), []
            for at in where:
                self.begin.setdefault(at, []).append(i)
                self.end.setdefault(at + size, []).append(i)
                if 0 < at and at + size < len(text) and p.match(text[at - 1 : at + size + 1], 1):
                    good.append(at)
                    places.append((at, i))
            self.good[i] = good
        places.sort()
        self.at, self.rule = [at for at, _ in places], [i for _, i in places]
        self.least = [min(self.rule[k : k + self.BLOCK]) for k in range(0, len(places), self.BLOCK)]
        self.longest = max(self.sizes.values(), default=0)

    def tried(self, i: int, at: int, a: int, b: int) -> re.Match | None:
        low = max(a, at - 1)
        return self.index.pattern(i).match(self.text[low : min(b, at + self.sizes[i] + 1)], at - low)

    def first(self, a: int, b: int) -> tuple[int, int] | None:
        """The first rule that matches within a..b, and where it first does."""
        ends = [(i, at) for i, at in [*((i, a) for i in self.begin.get(a, ())), *((i, b - self.sizes[i]) for i in self.end.get(b, ()))] if a <= at and at + self.sizes[i] <= b and self.tried(i, at, a, b)]
        best = min(ends, default=None)
        low = bisect_right(self.at, a)
        sure = max(low, bisect_left(self.at, b - self.longest))  # places from here on may reach beyond b
        k, n = -(-low // self.BLOCK), sure // self.BLOCK
        runs = (self.rule[low:sure],) if k >= n else (self.rule[low : k * self.BLOCK], self.least[k:n], self.rule[n * self.BLOCK : sure])
        inner = [min(run) for run in runs if run]
        inner += [self.rule[x] for x in range(sure, bisect_left(self.at, b)) if self.at[x] + self.sizes[self.rule[x]] < b]
        i = min(inner, default=None)
        if i is None or best is not None and best[0] < i:
            return best
        good = self.good[i]
        at = good[bisect_right(good, a)]
        return (i, at) if best is None or best[0] > i else min(best, (i, at))


def link_context(rows: list[tuple[int, str, str | None, str | None, bool]], rules: list[tuple[Rule, re.Pattern]] | Index) -> list[tuple[int, int, int, int]]:
    """AN6/AN7/WN2/F13 for the ordered texts (seq, text, atom, testament, in_keyword) of one context: links (seq, start, end, rule).

    In each unlinked stretch the first rule that passes and matches wins, and this repeats until none does. A rule that may not
    link again still consumes its match. Keywords are never linked. A rule's predicates (testament, contexts that it asks for, contexts that
    it excludes, in this order) are told once for each text, before any pattern is tried."""
    index = rules if isinstance(rules, Index) else Index([r for r, _ in rules], [""] * len(rules), {i: p for i, (_, p) in enumerate(rules)})
    used: set = set()
    out = []
    for seq, text, atom, half, keyword in rows:
        if not keyword and text:
            out += [(seq, *x) for x in _link_text(index, used, text, atom, half)]
    return out


def _link_text(index: Index, used: set, text: str, atom: str | None, half: str | None) -> list[tuple[int, int, int]]:
    """Links (start, end, rule) of one text; used: what its context has linked so far, which grows. Literal rules are looked up (see
    Places), the others tried in turn as far as they come before the literal one that is found."""
    literal_, other = [], []
    for i, where in index.places(text):
        rule = index.rules[i]
        if not (rule.only and half != rule.only or rule.context and not _admitted(rule.context, atom) or rule.not_context and _admitted(rule.not_context, atom)):
            (literal_ if i in index.literals else other).append((i, where, len(index.stems[i])))
    places = Places(index, text, literal_)
    span = lambda p, m: m.span("link" if "link" in p.groupindex else m.re.groups or 0)
    todo, taken = [(0, len(text))], []
    while todo:
        a, b = todo.pop()
        found = None
        if sure := places.first(a, b):
            i, at = sure
            low = max(a, at - 1)
            s, e = span(index.pattern(i), places.tried(i, at, a, b))
            found = i, low + s, low + e
        for i, where, size in other:
            if found and found[0] < i:
                break
            if where is not None:
                k = bisect_left(where, a)
                if k == len(where) or where[k] + size > b:
                    continue
            m = index.pattern(i).search(text[a:b])
            s, e = span(index.pattern(i), m) if m else (0, 0)
            if s >= 0 and s != e:
                found = i, a + s, a + e
                break
        if not found:
            continue
        i, s, e = found
        rule = index.rules[i]
        key = rule.entry if rule.multiple == "false" else i
        if not rule.dont_link and (rule.multiple == "true" or key not in used):
            used.add(key)
            taken.append((s, e, i))
        todo += [(e, b), (a, s)]
    return sorted(taken)


def link_terms(texts: DataFrame, rules: list[Rule], context: list[str]) -> DataFrame:
    """AN6/UX8: links of all texts: context columns, seq, start, end, entry, ref, text. texts: context columns, seq, text, atom, testament,
    in_keyword. A context (a chapter or keyword) is one task's, since what is linked there first decides the rest; its texts pass one by
    one, in the order of seq, and so do the contexts of a task. The rules go to every task; a text is tried with those only whose
    stems it holds (see Index)."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules are more than {MOST_RULES}")
    index = Index.of(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, used = None, set()
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in context), strict=True)
            atoms, halves, keywords, said = (batch.column(c) for c in ("atom", "testament", "in_keyword", "text"))
            rows, got, linked = [], [], []
            for n, key in enumerate(keys):
                key = tuple("NaN" if x != x else x for x in key)
                if key != last:
                    last, used = key, set()
                text = said[n].as_py()
                if keywords[n].as_py() or not text:
                    continue
                for s, e, i in _link_text(index, used, text, atoms[n].as_py(), halves[n].as_py()):
                    rows.append(n)
                    got.append((s, e, i))
                    linked.append(text[s:e])
            own = batch.take(pa.array(rows, pa.int64()))
            names = [*context, "seq", "start", "end", "entry", "ref", "text"]
            made = [pa.array([g[k] for g in got], pa.int32()) for k in (0, 1)] + [pa.array(x, pa.string()) for x in ([rules[g[2]].entry for g in got], [rules[g[2]].ref for g in got], linked)]
            yield pa.RecordBatch.from_arrays([*(own.column(c) for c in (*context, "seq")), *made], names=names)

    kinds = ", ".join(f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in context)
    ready = dealt(texts.withColumn("seq", F.col("seq").cast("long")), *context).sortWithinPartitions(*context, F.asc_nulls_last("seq"))
    return ready.mapInArrow(run, f"{kinds}, seq long, start int, end int, entry string, ref string, text string")


def default_rules(entries: DataFrame, key: str, scripture: bool = True) -> DataFrame:
    """AN10: (entry, seq, pattern) from keywords: variants split at , ; [ ] ( ) … /, the whole name too if there are several.
    Words of more than three letters match as prefixes in Scripture, others exactly. Longest rule first."""
    name = F.regexp_replace(F.regexp_replace(F.col(key), "!.*$", ""), "\\.dup\\d+$", "")
    parts = F.filter(F.transform(F.split(name, "[,;\\[\\]()…/]"), lambda x: F.trim(x)), lambda x: x != "")
    every = F.when(F.size(parts) > 1, F.array_union(F.array(name), parts)).otherwise(parts)
    rows = entries.select(F.col(key).alias("entry"), F.explode(every).alias("variant"))
    prefix = F.array_join(F.transform(F.split("variant", "\\s+"), lambda w: F.concat(F.lit("\\Q"), w, F.lit("\\E\\S*"))), " ")
    edge = lambda at: F.when(F.col("variant").rlike(at), F.lit("\\b")).otherwise("")
    exact = F.concat(edge("^[\\p{L}\\p{N}]"), F.lit("\\Q"), F.col("variant"), F.lit("\\E"), edge("[\\p{L}\\p{N}]$"))
    body = F.when(F.lit(scripture) & (F.length("variant") > 3), F.concat(F.lit("\\b("), prefix, F.lit(")"))).otherwise(F.concat(F.lit("("), exact, F.lit(")")))
    return rows.select("entry", F.col("variant"), F.concat(F.lit("/"), body, F.lit("/i")).alias("pattern"))


def rule_order(rules: DataFrame) -> list:
    """ST8: longest variant first, then by name."""
    return [F.length("variant").desc(), F.col("variant"), F.col("entry")]


def tighten(rules: DataFrame, short: int, frequent: int) -> DataFrame:
    """AG17/SK13: rules (variant, n, tier, pattern): tier B loses the flag i; short or frequent terms match whole words."""
    whole = (F.length("variant") <= short) | (F.col("n") > frequent)
    p = F.when(whole, F.replace("pattern", F.lit("\\S*"), F.lit("\\b"))).otherwise(F.col("pattern"))
    return rules.withColumn("pattern", F.when(F.col("tier") == "B", F.regexp_replace(p, "/i$", "/")).otherwise(p))
