"""Token counts by rank-synchronous array merging.

A batch's distinct pre-tokens are held as one ragged numpy array of symbol
ids.  Each round looks up the merge rank of every neighbouring pair, takes
each sequence's lowest rank, and merges all its occurrences in that sequence
at once (left to right where they overlap); sequences without a known pair are
done.  The number of surviving symbols is the token count of a pre-token; a
document's count is the sum over its pre-tokens.  A merged symbol never has a
merge of lower rank than the one that made it, so a round per lowest rank gives
what one merge at a time gives.

Plan: one scan, one Arrow map, no shuffle.  Memory: a batch of texts, the
vocabulary, and a cache of counted pre-tokens that is emptied at ``CACHE``
entries (a matter of speed only).

Defined results: a null or empty text has 0 bytes and 0 tokens; a null id
passes through; repeated rows give repeated rows; an empty table gives an empty
result.  Only the named id and text columns are read.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsignals.llm import wordbpe
from shopsignals.llm.common import arrow_rows, per_process, small_batches

CACHE = 1_000_000
#: pre-tokens longer than this are merged in a batch of their own
CHUNK_SYMBOLS = 2_000_000


def byte_alphabet() -> dict[int, str]:
    """Byte to printable character: printable Latin-1 stands for itself, the rest for 256 upwards."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Merges:
    """The vocabulary as arrays: symbols of bytes, and sorted pair keys with rank and result."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        self.size = max(vocab.values()) + 1
        end = model.get("end_of_word_suffix") or ""
        alphabet = byte_alphabet()
        self.inner = np.array([vocab.get(alphabet[b], -1) for b in range(256)], np.int64)
        self.last = np.array([vocab.get(alphabet[b] + end, -1) for b in range(256)], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order.astype(np.int64), made[order]

    def count(self, words: list[bytes]) -> np.ndarray:
        """Surviving symbols of each word (its UTF-8 bytes)."""
        out = np.zeros(len(words), np.int64)
        begin = 0
        while begin < len(words):
            end, total = begin, 0
            while end < len(words) and (end == begin or total + len(words[end]) <= CHUNK_SYMBOLS):
                total += len(words[end])
                end += 1
            out[begin:end] = self._count(words[begin:end])
            begin = end
        return out

    def _count(self, words: list[bytes]) -> np.ndarray:
        n = len(words)
        length = np.fromiter(map(len, words), np.int64, n)
        raw = np.frombuffer(b"".join(words), np.uint8)
        owner = np.repeat(np.arange(n), length)
        symbol = self.inner[raw]
        ends = np.cumsum(length)[length > 0] - 1
        symbol[ends] = self.last[raw[ends]]
        counts = length.copy()
        top = np.int64(len(self.keys))
        while len(symbol) > 1:
            pair = symbol[:-1] * self.size + symbol[1:]
            at = np.minimum(np.searchsorted(self.keys, pair), top - 1)
            known = (self.keys[at] == pair) & (owner[:-1] == owner[1:])
            rank = np.where(known, self.rank[at], top)
            # lowest rank of each sequence; the last position of the array begins no pair
            heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.minimum.reduceat(np.r_[rank, top], heads)
            spans = np.diff(np.r_[heads, len(owner)])
            alive = lowest < top
            if not alive.any():
                break
            hit = (rank == np.repeat(lowest, spans)[:-1]) & known
            # in a run of overlapping hits every other one is merged, from the left
            where = np.flatnonzero(hit)
            run_start = np.r_[True, np.diff(where) > 1]
            first = np.maximum.accumulate(np.where(run_start, np.arange(len(where)), 0))
            where = where[(np.arange(len(where)) - first) % 2 == 0]
            symbol = symbol.copy()
            symbol[where] = self.made[at[where]]
            keep = np.repeat(alive, spans)  # finished sequences leave the array
            counts[owner[heads][~alive]] = spans[~alive]
            keep[where + 1] = False
            symbol, owner = symbol[keep], owner[keep]
        if len(owner):
            left = np.bincount(owner, minlength=n)
            counts[left > 0] = left[left > 0]
        return counts


def _pretokens(text: str, library, alphabet_back: dict[str, int]) -> tuple[list[bytes], int]:
    """Pre-tokens of any text by the library's own steps, and the special strings in it."""
    found, specials = [], 0
    for piece in re.split("(" + "|".join(map(re.escape, wordbpe.SPECIAL)) + ")", text):
        if piece in wordbpe.SPECIAL:
            specials += 1
        elif piece:
            normal = library.normalizer.normalize_str(piece)
            found += [bytes(alphabet_back[c] for c in p) for p, _ in library.pre_tokenizer.pre_tokenize_str(normal)]
    return found, specials


class Counter:
    """Counts of texts, with caches of counted pre-tokens and of pieces between white space."""

    def __init__(self, path: str):
        self.merges, self.library = Merges(path), wordbpe.load_tokenizer(path)
        self.back = {c: b for b, c in byte_alphabet().items()}
        self.pretokens: dict = {}
        self.chunks: dict = {}

    def _learn(self, words: set) -> None:
        missing = [w for w in words if w not in self.pretokens]
        if missing:
            as_bytes = [w if isinstance(w, bytes) else w.encode() for w in missing]
            self.pretokens.update(zip(missing, self.merges.count(as_bytes).tolist()))

    def count(self, texts: list[str | None]) -> list[int]:
        for cache in (self.pretokens, self.chunks):
            if len(cache) > CACHE:
                cache.clear()
        chunks = self.chunks
        split = [wordbpe.chunks_plain(t) if t and wordbpe.plain(t) else None for t in texts]
        new = {c for s in split if s for c in s if c not in chunks}
        parts = {c: wordbpe.split_chunk(c) for c in new}
        other = [_pretokens(t, self.library, self.back) if t and s is None else ((), 0) for t, s in zip(texts, split)]
        self._learn({w for p in parts.values() for w in p} | {w for words, _ in other for w in words})
        lookup = self.pretokens.__getitem__
        chunks.update((c, sum(map(lookup, p))) for c, p in parts.items())
        return [
            sum(map(chunks.__getitem__, s)) if s is not None else sum(map(lookup, words)) + specials
            for s, (words, specials) in zip(split, other)
        ]


SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def token_counts(docs: DataFrame, path: str | None = None, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per row of ``docs``."""
    path = path or wordbpe.vocabulary_path()
    small_batches(docs.sparkSession, 512)

    def run(batches):
        counter = per_process(("token counter", path), lambda: Counter(path))
        for b in batches:
            texts = b.column(1).to_pylist()
            yield arrow_rows(SCHEMA, {
                "doc_id": b.column(0),
                "n_bytes": [len(t.encode()) if t else 0 for t in texts],
                "n_tokens": counter.count(texts),
            })

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
