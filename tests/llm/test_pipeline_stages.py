"""The pipeline's stages on one set of documents, each against a plain version on what the stage before kept."""

import random
import zlib

import corpus_pipeline
from tests.llm import brute


def documents():
    r = random.Random(40)
    words = [f"w{chr(97 + i % 26)}{i}" for i in range(300)]
    text = lambda n: [r.choice(words) for _ in range(n)]
    out = [(i * 2, text(r.randrange(1, 200))) for i in range(30)]
    for k in range(6):  # groups of near copies, in chains: each differs a little from the one before
        base = text(r.choice((30, 120, 400)))
        for j in range(5):
            out.append((100 + 10 * k + j, list(base)))
            for _ in range(max(1, len(base) // r.choice((15, 60, 200)))):
                base[r.randrange(len(base))] = r.choice(words)
    shared = text(60)
    out += [(200 + i, text(40) + shared[i:] + text(20)) for i in range(8)]  # passages that repeat
    out += [(300, text(3000)), (301, text(20) + ["password=hunter2secret99"]), (302, ["12", "---"]), (303, ["Same"]), (304, ["same"]), (305, text(2)), (306, [])]
    return [(i, " ".join(t)) for i, t in out] + [(400, None)]


def test_stages_by_brute_force(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    docs = documents()
    d = str(tmp_path / "sf")
    spark.createDataFrame([(i, t, "en" if i % 3 else "fr", "s", len(t or "")) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    got, seen = spark.read.parquet(f"{d}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, got, d).cache()
        seen[name] = got.collect()
    told = {r.doc_id: r.text for r in seen["language_id"]}
    assert told == {i: t for i, t in docs if any(c.isalpha() for c in t or "")}
    near = {r.doc_id: r.text for r in seen["simhash_near_dedup"]}
    want = brute.near_copies(list(told.items()), 5, 0.8)
    assert len(want) < len(told) - 10 and near == {i: told[i] for i in want}
    kept = sorted(near.items())
    left = {i: [w for w, k in zip(x, flags, strict=True) if k] for (i, _), (x, flags) in zip(kept, brute.later(kept, str.split, 20), strict=True)}
    sub = {r.doc_id: r.text for r in seen["substring_dedup"]}
    assert {i: t.split() for i, t in sub.items()} == {i: x for i, x in left.items() if x} and any(len(x) < len(near[i].split()) for i, x in left.items())
    clean = {r.doc_id: r.text for r in seen["secret_scans"]}
    assert {i for i in clean if clean[i] != sub[i]} == {301} and set(clean) == set(sub) and "hunter2" not in clean[301]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = []
    for i, t in clean.items():
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 0]
        first = len(ids) % 2048 or 2048
        at = [0, *range(first, len(ids), 2048)]
        pieces += [(i, n, a, b - a, zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[a:b]))) for n, (a, b) in enumerate(zip(at, [*at[1:], len(ids)], strict=True))]
    packed = seen["best_fit_packing"]
    assert sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in packed) == sorted((i, n, size, crc) for i, n, _, size, crc in pieces)
    pieces.sort(key=lambda x: (x[0], x[1], x[4]))
    bins = brute.best_fit([(x[3], 1, x[3] ** 2) for x in pieces], (2048, 2048, 2048**2), (1, 0.1, 0.1))
    assert {(r.doc_id, r.piece): r.sequence_id & (2**32 - 1) for r in packed} == {(x[0], x[1]): b for x, b in zip(pieces, bins, strict=True)}
    for s in {r.sequence_id for r in packed}:
        mine = sorted((r.offset, r.length) for r in packed if r.sequence_id == s)
        assert [o for o, _ in mine] == [sum(n for _, n in mine[:k]) for k in range(len(mine))] and sum(n for _, n in mine) <= 2048
