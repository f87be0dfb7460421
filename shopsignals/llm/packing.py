"""Best-fit packing of tokenised documents into sequences under several capacities.

1. One Arrow map tokenises whole texts, cuts those longer than the sequence
   into pieces, and numbers the pieces of equal length inside each task.  The
   pieces (no texts) are written once.
2. Demands depend on the length alone: (tokens, 1 document, length squared as
   attention cost).  So the packing is computed on the histogram of lengths,
   at most one row per token of a sequence whatever the corpus size.
   ``vector_best_fit`` goes from long to short; each length goes to the bins
   with the best score among those with room in *every* capacity.  Bins of
   equal content are one class with a range of bin numbers, so a step places
   all its documents at once.
3. Steps become ranges of ranks per length.  A piece's rank is its number in
   its task plus the pieces of that length in earlier tasks (a join with the
   small table of counts per task and length); the range holding the rank
   gives sequence and offset.  A hot length is spread over tasks like any
   other row: nothing is grouped by length but counts.

By default only tokens are limited: a limit on documents or attention cost can
only raise the number of sequences, and as few as possible are asked for.  The
two other demands then steer the choice of a bin through the score's weights
(short pieces go where documents and attention are left), and limit it as soon
as a capacity is given.

Defined results: a null or empty text is the closing id alone; null ids pass
through; repeated rows are packed once each; an empty table gives an empty
result.  Only the named id and text columns are read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopsignals.llm import wordbpe
from shopsignals.llm.common import arrow_rows, materialize, per_process, small_batches

#: entries of a worker's word caches; they are emptied beyond it (a matter of speed only)
CACHE = 1_000_000


@dataclass(frozen=True)
class Capacities:
    """Of one sequence; ``None`` means no limit.  Weights are those of the score."""

    tokens: int = 4096
    documents: int | None = None
    attention: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.1, 0.1)
    score: str = "norm"  # or "dot"

    def limits(self) -> np.ndarray:
        return np.array([self.tokens, self.documents or self.tokens, self.attention or self.tokens**2], np.float64)


def vector_best_fit(lengths: np.ndarray, counts: np.ndarray, cap: Capacities) -> np.ndarray:
    """Runs (length, first rank, how many, first bin, offset), in order of rank per length.

    ``counts[i]`` pieces have ``lengths[i]`` tokens.  A piece that is over a
    capacity by itself gets a sequence of its own.
    """
    limit, weight = cap.limits(), np.array(cap.weights)
    residual = np.zeros((1024, 3))
    count, first = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
    used, bins, runs = 0, 0, []

    def add(left: np.ndarray, n: int, at: int) -> None:
        nonlocal used, residual, count, first
        if n <= 0 or left[0] <= 0 or left[1] <= 0:
            return
        if used == len(count):
            live = np.flatnonzero(count[:used])
            if len(live) > used // 2:
                residual = np.vstack([residual, np.zeros_like(residual)])
                count, first = np.r_[count, np.zeros_like(count)], np.r_[first, np.zeros_like(first)]
            else:
                residual[: len(live)], count[: len(live)], first[: len(live)] = residual[live], count[live], first[live]
                count[len(live):] = 0
                used = len(live)
        residual[used], count[used], first[used] = left, n, at
        used += 1

    for i in np.argsort(-lengths, kind="stable"):
        length, n, rank = int(lengths[i]), int(counts[i]), 0
        need = np.array([length, 1.0, float(length) ** 2])
        while n:
            left = residual[:used]
            fits = np.flatnonzero((count[:used] > 0) & (left >= need).all(axis=1))
            if len(fits):
                share, want = left[fits] / limit, need / limit
                if cap.score == "dot":
                    best = fits[np.argmax((share * want) @ weight)]
                else:
                    best = fits[np.argmin(((share - want) ** 2) @ weight)]
                m = int(min(n, count[best]))
                offset, at = int(limit[0] - residual[best, 0]), int(first[best])
                rest = residual[best] - need
                count[best] -= m
                first[best] += m
                runs.append((length, rank, m, at, offset))
                add(rest, m, at)
                n, rank = n - m, rank + m
                continue
            each = max(1, int(np.floor(np.min(limit / need))))
            opened = n // each if n >= each else 1
            inside = min(each, n)
            for k in range(inside):
                runs.append((length, rank, opened, bins, k * length))
                rank += opened
            add(limit - need * inside, opened, bins)
            bins += opened
            n -= opened * inside
    return np.array(runs, np.int64).reshape(-1, 5)


class WordIds:
    """Ids of texts as bytes (little-endian unsigned 32 bit), word by word from a cache."""

    def __init__(self, path: str):
        self.library, self.words, self.chunks = wordbpe.load_tokenizer(path), {}, {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        encoded = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encoded]

    def _learn(self, chunks: set[str]) -> None:
        """Bytes of new pieces between white space, from the bytes of their pre-tokens."""
        parts = {c: (c,) if c.isalpha() else wordbpe.split_chunk(c) for c in chunks}
        words = self.words
        missing = list({w for p in parts.values() for w in p if w not in words})
        words.update(zip(missing, self._encode(missing)))
        self.chunks.update((c, b"".join(map(words.__getitem__, p))) for c, p in parts.items())

    def ids(self, texts: list[str | None]) -> list[bytes]:
        if len(self.words) > CACHE:
            self.words.clear()
        if len(self.chunks) > CACHE:
            self.chunks.clear()
        split = [wordbpe.chunks_plain(t) if t and wordbpe.plain(t) else None for t in texts]
        chunks = self.chunks
        self._learn({c for s in split if s for c in s if c not in chunks})
        return [
            b"".join(map(chunks.__getitem__, s)) if s is not None else self._encode([t])[0] if t else b""
            for t, s in zip(texts, split)
        ]


PIECES = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
    ("ids_crc32", pa.int64()), ("task", pa.int32()), ("number", pa.int64()),
])
PIECES_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, number long"


def token_pieces(docs: DataFrame, path: str, size: int, closing_id: int) -> DataFrame:
    """Pieces of every document, numbered per (task, length)."""
    close = np.array([closing_id], "<u4").tobytes()

    def run(batches):
        words = per_process(("word ids", path), lambda: WordIds(path))
        task, seen = TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for b in batches:
            out = {f.name: [] for f in PIECES}
            for doc_id, ids in zip(b.column(0).to_pylist(), words.ids(b.column(1).to_pylist())):
                ids = memoryview(ids + close)
                for piece, begin in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[begin : begin + 4 * size]
                    length = len(part) // 4
                    for name, value in zip(out, (doc_id, piece, begin // 4, length, zlib.crc32(part), task, int(seen[length]))):
                        out[name].append(value)
                    seen[length] += 1
            yield arrow_rows(PIECES, out)

    return docs.mapInArrow(run, PIECES_DDL)


PLACED = pa.schema([*[PIECES.field(i) for i in range(5)], ("sequence_id", pa.int64()), ("offset", pa.int64())])


def pack(docs: DataFrame, path: str | None = None, capacities: Capacities = Capacities(), closing_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id piece start length ids_crc32 sequence_id offset``."""
    spark = docs.sparkSession
    path = path or wordbpe.vocabulary_path()
    small_batches(spark, 512)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = materialize(token_pieces(slim, path, capacities.tokens, closing_id))
    per_task = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    # at most one row per possible length
    histogram = per_task.groupBy("length").agg(F.sum("n").alias("n")).orderBy("length").collect()
    runs = vector_best_fit(np.array([r["length"] for r in histogram], np.int64), np.array([r["n"] for r in histogram], np.int64), capacities)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    shared = spark.sparkContext.broadcast((runs[:, 0] * (1 << 40) + runs[:, 1], runs))
    before = per_task.select(
        "task", "length", (F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")).alias("before")
    )
    ranked = pieces.join(before, ["task", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("number") + F.col("before")).alias("rank")
    )

    def place(batches):
        keys, table = shared.value
        for b in batches:
            length, rank = b.column(3).to_numpy(), b.column(5).to_numpy()
            run = table[np.searchsorted(keys, length * (1 << 40) + rank, side="right") - 1]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(run[:, 3] + rank - run[:, 1]), pa.array(run[:, 4])], schema=PLACED
            )

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
