"""SentencePiece encoding and decoding over a trie of distinct marked words.

White space is marked and every distinct marked word of a batch that no recent batch had is encoded once. The words are sorted, so that going
through them is a depth-first walk of their trie: what is known about a common prefix, a forward column for every place in
it, is kept from the word before.

A unigram model asks for the best sum of scores: the usual Viterbi step. A BPE model asks for what its merges give, which
is not the best sum. It has a forward recurrence too: a text's merges leave the pieces a, b, ... just if every two
neighbours are what merging the two of them alone leaves, and just one last piece of each prefix meets this. So the same
walk keeps the one fitting last piece instead of the best.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quire.llm.common import small_batches, table

MARK = "▁"
#: Remembered verdicts on neighbouring pieces, and remembered words; beyond that the memory is emptied.
MEMORY, WORDS = 1_000_000, 500_000
#: Documents whose words are encoded together.
DOCS = 8192


class Pieces:
    """A vocabulary: pieces, their scores, and the ids of the 256 byte pieces. A character without a piece has the symbol -1 - its code."""

    def __init__(self, pieces: list[str], scores: list[float], byte_ids: list[int], special: set[int], bpe: bool) -> None:
        self.pieces, self.scores, self.byte_ids, self.bpe = pieces, scores, byte_ids, bpe
        skip = special | set(byte_ids)
        self.ids = {p: i for i, p in enumerate(pieces) if i not in skip}
        lengths: dict[str, set[int]] = {}
        for p in self.ids:
            if len(p) > 2:
                lengths.setdefault(p[-3:], {2, 1}).add(len(p))
        #: Lengths that pieces ending in three given characters may have, longest first.
        self.ending = {k: tuple(sorted(v, reverse=True)) for k, v in lengths.items()}
        self.known: dict[str, bytes] = {}
        self.fits: dict[int | None, dict[int, bool]] = {}
        self.judged = 0
        self.byte_of = {i: b for b, i in enumerate(byte_ids)}
        #: What each piece adds to a decoded text; None for byte pieces.
        self.shown = [None if i in self.byte_of else p.replace(MARK, " ") for i, p in enumerate(pieces)]
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece has a mark after another character, so words do not encode on their own")

    def spelled(self, symbol: int) -> str:
        return self.pieces[symbol] if symbol >= 0 else chr(-1 - symbol)

    def merged(self, text: str) -> list[str]:
        """The merges themselves: again and again the neighbours whose union scores highest, the leftmost of equals."""
        parts, get, scores = [*text], self.ids.get, self.scores
        ranks = [get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
        while True:
            best, at = None, -1
            for i, k in enumerate(ranks):
                if k is not None and (best is None or scores[k] > best):
                    best, at = scores[k], i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            ranks[at : at + 1] = []
            if at:
                ranks[at - 1] = get(parts[at - 1] + parts[at])
            if at < len(ranks):
                ranks[at] = get(parts[at] + parts[at + 1])

    def beside(self, left: int | None) -> dict[int, bool]:
        """What is known of the pieces that may follow left (None: nothing)."""
        return self.fits.setdefault(left, {})

    def judge(self, left: int | None, right: int) -> bool:
        """Whether merging both leaves just these two, or right alone if there is no left; remembered in beside(left)."""
        b = self.spelled(right)
        whole = [b] if left is None else [self.spelled(left), b]
        verdict = self.merged("".join(whole)) == whole
        self.fits[left][right] = verdict
        self.judged += 1
        return verdict

    def forget(self) -> None:
        """Empty what has grown beyond its limit; called between batches."""
        if self.judged > MEMORY:
            self.fits.clear()
            self.judged = 0
        if len(self.known) > WORDS:
            self.known.clear()

    def coded(self, symbols: list[int]) -> bytes:
        """Little-endian 32-bit ids of symbols; a character without a piece gives its bytes' pieces."""
        ids: list[int] = []
        for k in symbols:
            if k >= 0:
                ids.append(k)
            else:
                ids += [self.byte_ids[b] for b in chr(-1 - k).encode()]
        return np.array(ids, "<i4").tobytes()


@lru_cache(maxsize=2)
def load(path: str, bpe: bool = True) -> Pieces:
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    n = m.vocab_size()
    names = [m.id_to_piece(i) for i in range(n)]
    bytes_ = {names[i]: i for i in range(n) if m.is_byte(i)}
    return Pieces(names, [m.get_score(i) for i in range(n)], [bytes_[f"<0x{b:02X}>"] for b in range(256)], {i for i in range(n) if m.is_control(i) or m.is_unknown(i) or m.is_unused(i)}, bpe)


def encode_words(vocab: Pieces, words: list[str]) -> dict[str, bytes]:
    """The ids of distinct words. Column i stands for the first i characters: the last piece's symbol, where that piece
    begins, and the sum of scores (unigram) or what may follow the piece (BPE)."""
    get, scores, ending, bpe, short = vocab.ids.get, vocab.scores, vocab.ending, vocab.bpe, (2, 1)
    floor = min(scores, default=0.0) - 10.0  # of a character that only byte pieces give
    out: dict[str, bytes] = {}
    columns: list[tuple] = [(None, 0, vocab.beside(None) if bpe else 0.0)]
    before = ""
    for word in sorted(words):
        shared = 0
        for a, b in zip(before, word, strict=False):
            if a != b:
                break
            shared += 1
        del columns[shared + 1 :]
        for i in range(shared + 1, len(word) + 1):
            best = None
            for length in ending.get(word[i - 3 : i], short) if i > 2 else short:
                j = i - length
                if j < 0:
                    continue
                k = get(word[j:i])
                if k is None:
                    if length > 1:
                        continue
                    k = -1 - ord(word[j])
                left, _, forward = columns[j]
                if bpe:
                    verdict = forward.get(k)
                    if verdict is None:
                        verdict = vocab.judge(left, k)
                    if verdict:
                        best = (k, j, vocab.beside(k))
                        break
                else:
                    value = forward + (scores[k] if k >= 0 else floor)
                    if best is None or value > best[2]:
                        best = (k, j, value)
            columns.append(best)
        symbols = []
        i = len(word)
        while i:
            k, i, _ = columns[i]
            symbols.append(k)
        symbols.reverse()
        out[word] = vocab.coded(symbols)
        before = word
    return out


_SPLIT = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")


def marked(text: str) -> list[str]:
    """Marked words of a text: a mark is put before it and in place of each space. A line feed, which is in no longer piece, is one too."""
    return _SPLIT.findall(MARK + text.replace(" ", MARK)) if text else []


def encode_texts(vocab: Pieces, texts: list[str]) -> list[np.ndarray]:
    spoken = [marked(t) for t in texts]
    vocab.forget()
    known = vocab.known
    known |= encode_words(vocab, [*{w for s in spoken for w in s}.difference(known)])
    return [np.frombuffer(b"".join(map(known.__getitem__, s)), "<i4") for s in spoken]


def decode_ids(vocab: Pieces, ids: list[int]) -> str:
    """Text of ids: byte pieces in a row are UTF-8 (what is not becomes U+FFFD), marks become spaces, the first is dropped."""
    parts = [vocab.shown[k] for k in ids]
    if None in parts:
        byte_of = vocab.byte_of
        text = b"".join(bytes((byte_of[k],)) if p is None else p.encode() for p, k in zip(parts, ids, strict=True)).decode(errors="replace")
    else:
        text = "".join(parts)
    return text[1:] if text.startswith(" ") else text


def encode(docs: DataFrame, key: str, text: str, model: str | None = None, bpe: bool = True) -> DataFrame:
    """key and ids (array of int) for every row; null text has null ids, the empty text none. model: path of a
    SentencePiece file without normalization rules; without one, the 32,000-piece BPE file with byte fallback. Repeated
    rows are kept, other columns left out. One pass, no shuffle; a batch's words are known at a time, no more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = _vocabulary(model, bpe)
        for batch in batches:
            for i in range(0, batch.num_rows, DOCS):
                part = batch.slice(i, DOCS)
                texts = part.column(1).to_pylist()
                coded = encode_texts(vocab, [t or "" for t in texts])
                ids = pa.array([None if t is None else c for t, c in zip(texts, coded, strict=True)], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], ["key", "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.selectExpr(f"`{key}` AS key", f"`{text}` AS text").mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decode(coded: DataFrame, key: str, ids: str = "ids", model: str | None = None) -> DataFrame:
    """key and text for every row of ids; null ids give null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = _vocabulary(model, True)
        for batch in batches:
            texts = [None if x is None else decode_ids(vocab, x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["key", "text"])

    kind = coded.schema[key].dataType.simpleString()
    return coded.selectExpr(f"`{key}` AS key", f"`{ids}` AS ids").mapInArrow(run, f"key {kind}, text string").withColumnRenamed("key", key)


def _vocabulary(model: str | None, bpe: bool) -> Pieces:
    import public_tokenizers

    return load(model or public_tokenizers.path("piece_bpe_32k.model"), bpe)


def round_trip(docs: DataFrame, key: str, text: str, model: str | None = None) -> DataFrame:
    """key, n_pieces, ids_crc32 (of little-endian 32-bit ids), decoded_sha256 and same (whether decoding gives the text
    back). Null text counts as empty. A text that has U+2581 itself comes back with spaces there, as in the public library."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = _vocabulary(model, True)
        for batch in batches:
            for i in range(0, batch.num_rows, DOCS):
                part = batch.slice(i, DOCS)
                texts = [t or "" for t in part.column(1).to_pylist()]
                coded = encode_texts(vocab, texts)
                back = [decode_ids(vocab, c.tolist()) for c in coded]
                cols = [
                    pa.array([len(c) for c in coded], pa.int64()),
                    pa.array([zlib.crc32(c.astype("<u4").tobytes()) for c in coded], pa.int64()),
                    pa.array([hashlib.sha256(b.encode()).hexdigest() for b in back]),
                    pa.array([a == b for a, b in zip(texts, back, strict=True)]),
                ]
                yield pa.RecordBatch.from_arrays([part.column(0), *cols], ["key", "n_pieces", "ids_crc32", "decoded_sha256", "same"])

    small_batches(docs.sparkSession, DOCS)
    kind = docs.schema[key].dataType.simpleString()
    return docs.selectExpr(f"`{key}` AS key", f"`{text}` AS text").mapInArrow(run, f"key {kind}, n_pieces bigint, ids_crc32 bigint, decoded_sha256 string, same boolean").withColumnRenamed("key", key)


def op6_sentencepiece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), "doc_id", "text")
