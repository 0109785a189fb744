"""Corpus encoding with a public byte-level BPE vocabulary.

A text is cut into pieces by the vocabulary's pre-tokeniser pattern and each
distinct piece is encoded once per worker.  A piece's bytes are read as Latin-1
text, so that an Aho-Corasick automaton over the vocabulary finds every token
that starts at each byte.  Encoding walks from longest matches and backtracks:
a token may follow another only if byte-pair merging of the two tokens' bytes
gives back exactly those two tokens.  That test depends on the pair alone and is
memoised; a sequence whose adjacent pairs all pass is the one merging produces.
A byte offset that could not be continued is never tried again, so the work is
linear in the piece's length.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the public vocabulary lies on every machine; pass another path to move it.
BYTE_BPE_50K = "/opt/tokenizers/byte_bpe_50k.json"
#: Fixed value: the published pre-tokeniser pattern of this vocabulary.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _printable_bytes() -> dict[str, int]:
    """The vocabulary files' letter for each byte: printable bytes stand for themselves, the rest follow from U+0100."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class BytePairEncoder:
    """Encoder over a ``tokenizers`` BPE file; exact merges by longest match and backtracking."""

    def __init__(self, path: str = BYTE_BPE_50K, cached_pieces: int = 200_000):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        as_byte = _printable_bytes()
        self.id_of = {"".join(chr(as_byte[c]) for c in token): i for token, i in model["vocab"].items() if all(c in as_byte for c in token)}
        latin = lambda token: "".join(chr(as_byte[c]) for c in token)
        self.merged: dict[tuple[int, int], int] = {}
        self.rank: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b = self.id_of[latin(left)], self.id_of[latin(right)]
            whole = self.id_of[latin(left + right)]
            self.merged[a, b] = whole
            if whole not in self.rank:
                self.rank[whole], self.parts[whole] = rank, (a, b)
        reachable = {t: i for t, i in self.id_of.items() if len(t) == 1 or i in self.rank}
        self.length = {i: len(t) for t, i in reachable.items()}
        self.automaton = ahocorasick.Automaton()
        for token, i in reachable.items():
            self.automaton.add_word(token, (len(token), i))
        self.automaton.make_automaton()
        self.find = regex.compile(PIECES).findall
        self.fits: dict[tuple[int, int], bool] = {}
        self.cache: dict[str, list[int]] = {}
        self.cached_pieces = cached_pieces

    def _adjacent(self, left: int, right: int) -> bool:
        """Does merging the bytes of both tokens stop at exactly these two?

        Undo merges on the two sides of the cut, latest first.  At every state a
        merge across the cut would have been taken if it came before all merges
        still to be done, which are those undone so far.
        """
        known = self.fits.get((left, right))
        if known is not None:
            return known
        a, b, rank, never = left, right, self.rank, len(self.rank) + 1
        before = never
        result = True
        while True:
            across = self.merged.get((a, b))
            if across is not None and rank[across] < before:
                result = False
                break
            ra, rb = rank.get(a, -1), rank.get(b, -1)
            if ra < 0 and rb < 0:
                break
            if ra > rb:
                before, a = ra, self.parts[a][1]
            else:
                # of equal ranks the left one is merged first, so the right one is undone first;
                # a merge across of this very rank starts further left and would come before it
                before, b = rb + 1, self.parts[b][0]
        self.fits[left, right] = result
        return result

    def encode_bytes(self, piece: bytes) -> list[int]:
        text = piece.decode("latin-1")
        whole = self.id_of.get(text)
        if whole is not None and whole in self.length:
            return [whole]
        n = len(text)
        starts: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for last, hit in self.automaton.iter(text):
            starts[last - hit[0] + 1].append(hit)
        # hits of one start arrive in order of their length: the longest is last
        dead = bytearray(n + 1)
        out: list[int] = []
        choice: list[int] = []
        pos, k = 0, len(starts[0]) - 1
        while pos < n:
            options = starts[pos]
            while k >= 0:
                size, token = options[k]
                if not dead[pos + size] and (not out or self._adjacent(out[-1], token)):
                    break
                k -= 1
            if k >= 0:
                out.append(token)
                choice.append(k)
                pos += size
                k = len(starts[pos]) - 1 if pos < n else -1
            else:
                dead[pos] = 1
                last_token = out.pop()
                pos -= self.length[last_token]
                k = choice.pop() - 1
        return out

    def encode(self, text: str) -> list[int]:
        """Token ids of a text, no special tokens; a lone surrogate, which no Spark string holds, becomes a question mark."""
        cache, out = self.cache, []
        for piece in self.find(text):
            ids = cache.get(piece)
            if ids is None:
                ids = self._learn(piece)
            out += ids
        return out

    def count(self, text: str) -> int:
        cache, n = self.cache, 0
        for piece in self.find(text):
            ids = cache.get(piece)
            n += len(ids if ids is not None else self._learn(piece))
        return n

    def _learn(self, piece: str) -> list[int]:
        ids = self.encode_bytes(piece.encode("utf-8", "replace"))
        if len(piece) <= 64:
            if len(self.cache) >= self.cached_pieces:
                self.cache.clear()
            self.cache[piece] = ids
        return ids


_ENCODERS: dict[str, BytePairEncoder] = {}


def encoder(path: str = BYTE_BPE_50K) -> BytePairEncoder:
    """The worker's encoder for a vocabulary, built once per process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = BytePairEncoder(path)
    return _ENCODERS[path]


def encode_documents(documents: DataFrame, path: str = BYTE_BPE_50K, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: each row's text as stored, encoded without special tokens.

    Null and empty texts give the empty list; a row repeated in the input is
    repeated in the output; other columns are not read.  One narrow pass: no
    shuffle, nothing collected, memory of one Arrow batch per task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            ids: list[int] = []
            ends = [0]
            for text in batch.column(1).to_pylist():
                if text:
                    ids += encode(text)
                ends.append(len(ids))
            values = pa.array(np.array(ids, dtype=np.int32))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["doc_id", "ids"])

    rows = documents.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, ids array<int>")


def count_tokens(documents: DataFrame, path: str = BYTE_BPE_50K, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, tokens``: the lengths of :func:`encode_documents`' lists; null and empty texts have 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = encoder(path).count
        for batch in batches:
            sizes = [count(t) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], names=["doc_id", "tokens"])

    rows = documents.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, tokens bigint")
