"""The term linker with its index against every rule on every stretch."""

import random
import re
import time

from quire.operators import terms


def every_rule(rows, rules):
    """Links by trying each rule in each stretch."""
    used, out = set(), []
    for seq, text, atom, _, _ in rows:
        todo, taken = [(0, len(text))], []
        while todo:
            a, b = todo.pop()
            for i, r in enumerate(rules):
                m = terms.compile_rule(r.pattern).search(text[a:b])
                if not m or m.start(m.re.groups) == m.end(m.re.groups):
                    continue
                s, e = m.span(m.re.groups)
                key = r.entry if r.multiple == "false" else i
                if not r.dont_link and (r.multiple == "true" or key not in used):
                    used.add(key)
                    taken.append((seq, a + s, a + e, i))
                todo += [(a + e, b), (a, a + s)]
                break
        out += sorted(taken)
    return out


def test_index_equals_every_rule():
    r = random.Random(1)
    letters = "abcABCß İıſKkσςΣé-"
    shapes = (r"\b(\Q{0}\E\S*)", r"(\Q{0}\E)", r"\b(\Q{0}\E)\b", r"({0}+)x?", r"(?:{0}){{1,2}}({1})", r"([{0}]{1})", r"({0}|{1})", r"({0}*)")
    for n in range(300):
        word = lambda: "".join(r.choice("abcABCßİıſKkσςΣé") for _ in range(r.randrange(1, 3)))  # noqa: E731, B023
        rules = [terms.Rule(f"e{r.randrange(6)}", "r", f"/{r.choice(shapes).format(word(), word())}/{r.choice(('', 'i'))}", r.choice(("true", "false", "match")), dont_link=r.random() < 0.1) for _ in range(8)]
        rows = [(k, "".join(r.choice(letters) for _ in range(r.randrange(30))), None, None, False) for k in range(3)]
        assert terms.link_context(rows, terms.Index.of(rules)) == every_rule(rows, rules), n


def test_folding_follows_patterns_without_case():
    """Characters that a pattern without case takes for the same fold to the same, unless no stem has them."""
    cased = [c for c in map(chr, range(0x250)) if c.isalpha()] + list("ſKÅµμσςΣϐβẞß")
    for a in cased:
        for b in {a.lower(), a.upper(), a.casefold(), *"ſKÅµμσςΣϐβiIİı"}:
            if len(b) == 1 and re.fullmatch(re.escape(a), b, re.I) and terms._plain(a):
                assert terms.folded("é" + a) == terms.folded("é" + b), (a, b)


def test_stems():
    got = {p: terms.stem(terms.compile_rule(p)) for p in (r"/\b(\QAb c\E\S*)/i", "/a?bc/", "/(x|y)/", "/(?:ab)+c/", "/straße/i", "/(a)(b)c/")}
    assert list(got.values()) == ["ab c", "bc", "", "ab", "stra", "abc"]


def test_many_rules_cost_little_more_than_few():
    r = random.Random(2)
    vocabulary = ["".join(r.choice("abcdefghij") for _ in range(7)) for _ in range(20_000)]
    rows = [(k, " ".join(r.choice(vocabulary) for _ in range(400)), None, None, False) for k in range(40)]
    seconds = []
    for n in (100, 10_000):
        index = terms.Index.of([terms.Rule(w, w, rf"/\b(\Q{w}\E)\b/i") for w in vocabulary[:n]])
        terms.link_context(rows[:1], index)
        began = time.process_time()
        got = [terms.link_context([x], index) for x in rows]
        seconds.append((time.process_time() - began) / max(1, sum(map(len, got))) if n > 100 else time.process_time() - began)
    assert seconds[1] < 2e-3  # a link of ten thousand rules: no rule is tried in vain


def test_links_are_in_document_order(spark):
    rules = [terms.Rule("House", "D:House", r"/\b(house\S*)/i"), terms.Rule("The", "D:The", r"/\b(the)\b/i", multiple="match")]
    df = spark.createDataFrame([("c", 2, "the house", None, None, False), ("c", 1, "a House, the houses", None, None, False), ("d", 1, None, None, None, False), ("d", 2, "the", None, None, True)], "c string, seq long, text string, atom string, testament string, in_keyword boolean")
    got = sorted((x.c, x.seq, x.start, x.end, x.entry, x.text) for x in terms.link_terms(df, rules, ["c"]).collect())
    assert got == [("c", 1, 2, 8, "House", "House,"), ("c", 1, 9, 12, "The", "the")]


def test_literal_rules_at_the_ends_of_stretches():
    rnd = random.Random(5)
    shapes = [r"/\b(%s)\b/", r"/(%s)/i", r"/\b(%s)/", r"/\B(%s)\b/i", r"/(%s)\B/", r"/%s/", r"/\b(\w*%s)\b/", r"/(%s\w+)/i"]
    for _ in range(400):
        pick = lambda: rnd.choice(shapes) % rnd.choice(["ab", "abc", "b", "bc", "ca", "a b", "Ab", "c"])
        rules = [terms.Rule(f"e{rnd.randrange(4)}", "", pick(), multiple=rnd.choice(["false", "match", "true"]), dont_link=rnd.random() < 0.1) for _ in range(5)]
        rows = [(s, "".join(rnd.choice("abcABC  .") for _ in range(50)), None, None, False) for s in range(2)]
        assert terms.link_context(rows, terms.Index.of(rules)) == every_rule(rows, rules)


def test_a_long_text_of_many_terms():
    index = terms.Index.of([terms.Rule(f"w{i}", "", f"/\\b(\\Qterm{i:03}\\E)\\b/", multiple="match") for i in range(500)])
    # each stem stands in longer words too, where it is no match
    text = " ".join(f"term{i * 7 % 500:03} term{i * 11 % 500:03}s" for i in range(10_000))
    began = time.time()
    assert len(terms.link_context([(0, text, None, None, False)], index)) == 500
    assert time.time() - began < 10


def test_many_small_contexts_in_one_pass(spark):
    rows = [(k, n, "an ark of Arks, an ark", None, None, False) for k in (*range(40), None) for n in (2, 1, 3)]
    texts = spark.createDataFrame(rows, "k long, seq int, text string, atom string, testament string, in_keyword boolean")
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")  # contexts are cut by batches
    got = terms.link_terms(texts, [terms.Rule("Ark", "D", r"/\b(ark)\b/")], ["k"])
    assert "FlatMapGroups" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, got.collect())) == sorted(f"Row(k={k}, seq=1, start=3, end=6, entry='Ark', ref='D', text='ark')" for k in (*range(40), None))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
