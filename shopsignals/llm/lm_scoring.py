"""Language-model scoring with a log-bilinear model trained by noise-contrastive estimation.

Corpus counts: every training document's words and one end token are counted
(``word, c``); this table, its totals and the unigram base score cover all
training documents and grow with them.

Model: the ``TOP`` most frequent tokens are outcomes of their own; every other
token falls into one of ``CLASSES`` classes by the CRC-32 of its last two
characters.  The vector of the next outcome is predicted as the sum of
position-weighted vectors of the two outcomes before it, and scores are its
products with the output vectors plus a bias.  Training is numpy: each task
runs noise-contrastive updates (noise: the counted unigram shares) over
its own part of the corpus, and the tasks' parameters are averaged by Spark,
weighted by positions, after each of ``PASSES`` passes.  Every pass takes the
whole texts of all training documents.

Texts are split twice: once to count words, once to write each document as the
array of its outcomes (two bytes a token) with its counted words; training
passes and scoring read the arrays.  Both splits work on whole Arrow batches:
a batch's distinct words are looked up once, all else is numpy over its tokens.

Scoring: a score is a sum of one product per preceding outcome, so two matrix
products give all of them, and a third (of their exponentials) the normaliser
of every pair of preceding outcomes; a token's normalised log-probability is
then four table lookups.  A token of a class has the class's probability times
``(c + 1) / (N_class + V_class + 1)``; summed over the class's known tokens and
one unknown one that is 1, so the score is a proper log10 probability.

Counts of tokens beyond the ``FREQUENT`` most frequent (a bounded broadcast)
are not sent to tasks: their (document, word) pairs are joined with the table.

Defined results: null and empty texts are the end token alone; a null id is
not held out and not trained on; rows that repeat an id are scored each and
trained on each; without training documents N is 0, the base score is 0 per
token and the model falls back to equal outcomes; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsignals.llm.common import arrow_rows, ascii_lower, bucket_of, materialize, small_batches, words_in

TOP = 704
CLASSES = 64
FREQUENT = 100_000
TOP_TASKS = 4
DIM = 24
NOISE = 12
BLOCK = 2048
#: positions of a block whose noise scores are held at once (they stay in the cache)
CHUNK = 256
PASSES = 2
#: bytes of texts or arrays that are taken at once, whatever a batch holds
SLICE_BYTES = 16 << 20
#: a task counts so many words, or bytes of them, before it sends counts
COUNTED_WORDS, COUNTED_BYTES = 4_000_000, 64 << 20
#: rows of one batch of counts
COUNT_ROWS = 100_000
#: the end token; a space can be no word
END = " "


def tokens_of(text: str | None) -> list[str]:
    """The tokens of one text; ``batch_words`` gives the words of many."""
    words = words_in(ascii_lower(text)) if text else []
    words.append(END)
    return words


def slices(batches, column: int):
    """The batches in slices whose texts hold at most SLICE_BYTES; a longer text is a slice of its own."""
    for b in batches:
        ends, lo = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64), 0
        while lo < b.num_rows:
            before = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
            yield b.slice(lo, hi - lo)
            lo = hi


def batch_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in one array, and how many each text has (null: none)."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.string())))
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    words = lists.flatten()
    real = pc.not_equal(pc.binary_length(words), 0)  # white space at either end leaves an empty piece
    before = np.r_[0, np.cumsum(real.to_numpy(zero_copy_only=False))]
    ends = np.cumsum(sizes)
    return words.filter(real), before[ends] - before[ends - sizes]


def class_of(word: str) -> int:
    return zlib.crc32(word[-2:].encode()) % CLASSES


def classes_of(words: pa.Array) -> np.ndarray:
    """``class_of`` of every word, computed once for each ending."""
    ending = pc.utf8_slice_codeunits(words, -2).dictionary_encode()
    own = np.array([class_of(w) for w in ending.dictionary.to_pylist()], np.int16)
    return own[ending.indices.to_numpy()]


def class_column(word):
    return (F.crc32(F.encode(F.right(word, F.lit(2)), "utf-8")) % CLASSES).cast("int")


COUNTS = pa.schema([("word", pa.string()), ("c", pa.int64())])


def word_counts(training: DataFrame) -> DataFrame:
    """``word, c`` over all training texts; tasks send partial counts."""

    def told(words, documents):
        if words:
            found = pa.chunked_array(words).value_counts()
            counted = pa.RecordBatch.from_arrays([found.field(0), found.field(1)], schema=COUNTS)
            for lo in range(0, len(counted), COUNT_ROWS):
                yield counted.slice(lo, COUNT_ROWS)
        if documents:
            yield arrow_rows(COUNTS, {"word": [END], "c": [documents]})

    def run(batches):
        held, documents, size, weight = [], 0, 0, 0
        for b in slices(batches, 0):
            words, _ = batch_words(b.column(0))
            documents += b.num_rows
            if len(words):
                held.append(words)
                size, weight = size + len(words), weight + words.nbytes
            if size > COUNTED_WORDS or weight > COUNTED_BYTES:
                yield from told(held, documents)
                held, documents, size, weight = [], 0, 0, 0
        yield from told(held, documents)

    return training.select("text").mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def most_frequent(counts: DataFrame, n: int) -> list[tuple[str, int]]:
    """The ``n`` words of highest count (ties by word).

    A histogram of counts (16 steps a doubling, so about a thousand rows at
    most) tells which words can be among them; those go to ``TOP_TASKS`` tasks,
    each of which sends at most ``n`` rows however many tasks hold the table.
    """
    step = F.floor(F.log2("c") * 16)
    sizes = sorted(((r["s"], r["n"]) for r in counts.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    least, total = None, 0
    for s, size in sizes:
        if total >= n:
            break
        least, total = s, total + size
    if least is None:
        return []
    rows = counts.where(step >= least).repartition(TOP_TASKS).orderBy(F.desc("c"), "word").limit(n).collect()
    return [(r["word"], r["c"]) for r in rows]


def _added_rows(n: int, ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """``n`` rows: the sums of the rows of each id."""
    order = np.argsort(ids.astype(np.int16), kind="stable")
    ids = ids[order]
    heads = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
    total = np.zeros((n, rows.shape[1]), rows.dtype)
    total[ids[heads]] = np.add.reduceat(rows.take(order, axis=0), heads, axis=0)
    return total


class LogBilinear:
    """Parameters: input vectors r, output vectors q, biases, weights of the two positions."""

    def __init__(self, noise: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        n = len(noise)
        self.noise = noise
        self.r = (0.1 * rng.standard_normal((n + 1, DIM))).astype(np.float32)  # the last stands before the text
        self.q = (0.1 * rng.standard_normal((n, DIM))).astype(np.float32)
        self.bias = np.log(noise).astype(np.float32)
        self.position = np.full((2, DIM), 0.5, np.float32)

    def rows(self) -> np.ndarray:
        """All parameters as one matrix with DIM + 1 columns."""
        top = np.hstack([self.q, self.bias[:, None]])
        rest = np.vstack([self.r, self.position])
        return np.vstack([top, np.hstack([rest, np.zeros((len(rest), 1), np.float32)])])

    def load(self, rows: np.ndarray) -> None:
        n = len(self.noise)
        self.q, self.bias = rows[:n, :DIM].astype(np.float32), rows[:n, DIM].astype(np.float32)
        self.r, self.position = rows[n : 2 * n + 1, :DIM].astype(np.float32), rows[2 * n + 1 :, :DIM].astype(np.float32)

    def predicted(self, before: np.ndarray) -> np.ndarray:
        return self.r[before[:, 0]] * self.position[0] + self.r[before[:, 1]] * self.position[1]

    def step(self, before: np.ndarray, outcome: np.ndarray, rng, rate: float, state: dict) -> None:
        """One noise-contrastive update: the block's noise sample is shared by its positions."""
        n, size = len(self.noise), len(outcome)
        share = np.float32(1 / size)
        noise = rng.choice(n, NOISE * 8, p=self.noise)
        level = self.bias - np.log(len(noise) * self.noise).astype(np.float32)
        # a last column of ones carries the levels through the products
        inputs = np.ones((size, DIM + 1), np.float32)
        h = inputs[:, :DIM]
        np.add((self.r * self.position[0]).take(before[:, 0], axis=0), (self.r * self.position[1]).take(before[:, 1], axis=0), out=h)
        drawn = self.q[noise]
        scorer = -np.hstack([drawn, level[noise, None]]).T
        dh, dnoise = np.empty((size, DIM), np.float32), np.zeros((DIM + 1, len(noise)), np.float32)
        held = np.empty((min(CHUNK, size), len(noise)), np.float32)
        for lo in range(0, size, CHUNK):
            part = inputs[lo : lo + CHUNK]
            g_fake = np.matmul(part, scorer, out=held[: len(part)])
            np.exp(g_fake, out=g_fake)
            g_fake += 1
            np.divide(-share, g_fake, out=g_fake)
            dnoise += part.T @ g_fake
            np.matmul(g_fake, drawn, out=dh[lo : lo + CHUNK])
        target = self.q.take(outcome, axis=0)
        g_true = share / (1 + np.exp(np.einsum("ij,ij->i", h, target) + level[outcome]))  # ascent on log sigmoid
        target *= g_true[:, None]
        dh += target
        dq = _added_rows(n, outcome, h * g_true[:, None])
        np.add.at(dq, noise, dnoise[:DIM].T)
        db = np.bincount(outcome, g_true, n) + np.bincount(noise, dnoise[DIM], n)
        dr, dp = np.zeros_like(self.r), np.empty_like(self.position)
        for j in range(2):
            by_input = _added_rows(n + 1, before[:, j], dh)
            dp[j] = np.einsum("ij,ij->j", by_input, self.r)
            by_input *= self.position[j]
            dr += by_input
        for name, g in (("q", dq), ("bias", db.astype(np.float32)), ("r", dr), ("position", dp)):
            s = state.setdefault(name, np.full(g.shape, 1e-8, np.float32))
            s += g * g
            g *= np.float32(rate)
            g /= np.sqrt(s)
            getattr(self, name)[...] += g

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(near, far, log_z): an outcome ``w`` after ``a`` (nearest) and ``b`` has the
        log-probability ``near[a, w] + far[b, w] - log_z[a, b]``."""
        q = self.q.astype(np.float64).T
        near = (self.r * self.position[0]).astype(np.float64) @ q + self.bias
        far = (self.r * self.position[1]).astype(np.float64) @ q
        top_near, top_far = near.max(1, keepdims=True), far.max(1, keepdims=True)
        log_z = np.log(np.exp(near - top_near) @ np.exp(far - top_far).T) + top_near + top_far.T
        return near, far, log_z


def _joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The outcomes of a column of arrays behind each other, and the bounds of its documents."""
    column = column.cast(pa.binary())
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) // 2
    return np.frombuffer(data, "<i2", bounds[-1])[bounds[0] :], bounds - bounds[0]


def _contexts(flat: np.ndarray, bounds: np.ndarray, start: int) -> np.ndarray:
    """Two rows: the outcomes before each position (nearest first); ``start`` stands before a text."""
    before, first = np.empty((2, len(flat)), np.int16), bounds[:-1]
    for row, nearer in zip(before, (flat, before[0])):
        row[1:] = nearer[:-1]
        row[first] = start
    return before


def training_blocks(batches, start: int, block: int):
    """``before, outcome`` of all documents: whole ones until ``block`` positions are there, cut at ``block`` positions."""
    held, size = [], 0
    for b in slices(batches, 0):
        flat, bounds = _joined(b.column(0))
        before, lo = _contexts(flat, bounds, start), 0
        for hi in bounds[1:].tolist():
            if size + hi - lo >= block:
                held.append((before[:, lo:hi], flat[lo:hi]))
                x, y = (np.concatenate(side, axis=-1) for side in zip(*held))
                for at in range(0, len(y), block):
                    yield x[:, at : at + block].T, y[at : at + block]
                held, size, lo = [], 0, hi
        if lo < len(flat):
            held.append((before[:, lo:], flat[lo:]))
            size += len(flat) - lo
    if held:
        x, y = (np.concatenate(side, axis=-1) for side in zip(*held))
        yield x.T, y


PARAMS = pa.schema([("row", pa.int32()), ("weight", pa.float64()), ("values", pa.list_(pa.float32()))])


def train(coded: DataFrame, noise: np.ndarray) -> LogBilinear:
    """Parameter averaging over the tasks' noise-contrastive training on the arrays ``ids``."""
    model = LogBilinear(noise)
    for epoch in range(PASSES):
        start = model.rows()

        def run(batches, start=start, epoch=epoch):
            own = LogBilinear(noise)
            own.load(start)
            rng = np.random.default_rng([epoch, TaskContext.get().partitionId()])
            state: dict = {}
            seen = 0
            for before, outcome in training_blocks(batches, len(noise), BLOCK):
                own.step(before, outcome, rng, 0.12 / (1 + epoch), state)
                seen += len(outcome)
            if seen:
                rows = own.rows()
                yield arrow_rows(PARAMS, {"row": np.arange(len(rows)), "weight": np.full(len(rows), float(seen)), "values": list(rows)})

        told = coded.where("trains").select("ids").mapInArrow(run, "row int, weight double, values array<float>")
        each = told.select("row", "weight", F.posexplode("values").alias("col", "x"))
        mean = each.groupBy("row", "col").agg((F.sum(F.col("x") * F.col("weight")) / F.sum("weight")).alias("x"))
        rows = mean.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("col", "x"))).alias("values")).select("row", "values.x").collect()
        if not rows:
            break
        averaged = start.copy()
        for r in rows:
            averaged[r["row"]] = r["x"]
        model.load(averaged)
    return model


CODED = pa.schema([
    ("row", pa.int64()), ("doc_id", pa.int64()), ("trains", pa.bool_()), ("ids", pa.binary()), ("n_tokens", pa.int64()), ("known", pa.int64()),
    ("base", pa.float64()), ("inner", pa.float64()), ("rare", pa.list_(pa.string())), ("times", pa.list_(pa.int32())),
])
CODED_DDL = "row long, doc_id long, trains boolean, ids binary, n_tokens long, known long, base double, inner double, rare array<string>, times array<int>"


def coded_documents(docs: DataFrame, n_top: int, common) -> DataFrame:
    """Documents as outcome arrays, with what their words' counts add to the scores.

    ``common`` broadcasts the most frequent words and their counts, the ``n_top``
    outcomes first; other words are listed (``rare, times``) for a join with the
    table of counts.  ``base`` is the sum of log10(c + 1) over the frequent words,
    ``inner`` that over those among them that are no outcome of their own.
    """

    def run(batches):
        words, counts = common.value
        frequent = pa.array(words, pa.string())
        # one entry more, for a word that is not among them
        outcome_of = np.r_[np.arange(n_top), n_top + classes_of(frequent[n_top:]), 0].astype("<i2")
        logged = np.r_[np.log10(np.array(counts, float) + 1), 0.0]
        row = TaskContext.get().partitionId() << 40
        for b in slices(batches, 1):
            words, sizes = batch_words(b.column(1))
            coded = words.dictionary_encode()
            distinct = pa.concat_arrays([coded.dictionary, pa.array([END])])
            rank = pc.fill_null(pc.index_in(distinct, value_set=frequent), len(frequent)).to_numpy()
            is_rare = rank == len(frequent)
            outcome = outcome_of[rank]
            outcome[is_rare] = n_top + classes_of(distinct.filter(pa.array(is_rare)))

            bounds = np.r_[0, np.cumsum(sizes + 1)]
            tokens = np.full(bounds[-1], len(distinct) - 1, np.int32)
            inside = np.ones(len(tokens), bool)
            inside[bounds[1:] - 1] = False
            tokens[inside] = coded.indices.to_numpy()

            of_doc = lambda x: np.add.reduceat(x[tokens], bounds[:-1])
            at = np.flatnonzero(is_rare[tokens])
            doc = np.searchsorted(bounds, at, "right") - 1
            pairs, times = np.unique(doc * len(distinct) + tokens[at], return_counts=True)
            rare_bounds = np.searchsorted(pairs, np.arange(b.num_rows + 1) * len(distinct)).astype(np.int32)
            rare = distinct.take(pa.array(pairs % len(distinct)))
            ids = [None, pa.py_buffer((2 * bounds).astype(np.int32)), pa.py_buffer(outcome[tokens])]
            yield pa.RecordBatch.from_arrays([
                pa.array(row + np.arange(b.num_rows)), b.column(0), b.column(2), pa.Array.from_buffers(pa.binary(), b.num_rows, ids),
                pa.array(sizes + 1), pa.array(of_doc((~is_rare).astype(np.int64))),
                pa.array(of_doc(logged[rank])), pa.array(of_doc(np.where(rank < n_top, 0.0, logged[rank]))),
                pa.ListArray.from_arrays(rare_bounds, rare), pa.ListArray.from_arrays(rare_bounds, pa.array(times.astype(np.int32))),
            ], schema=CODED)
            row += b.num_rows

    return docs.mapInArrow(run, CODED_DDL)


def model_scores(coded: DataFrame, tables, class_size: np.ndarray, n_top: int) -> DataFrame:
    """The rows with ``model``, the log10 probability of their arrays less the sizes of the classes, in place of ``ids``."""
    kept = [f for f in CODED if f.name in ("row", "doc_id", "n_tokens", "known", "base", "inner")]
    schema = pa.schema([*kept, pa.field("model", pa.float64())])

    def run(batches):
        near, far, log_z = tables.value
        for b in slices(batches, 0):
            flat, bounds = _joined(b.column(0))
            nearest, second = _contexts(flat, bounds, len(log_z) - 1)
            log_p = near[nearest, flat] + far[second, flat] - log_z[nearest, second]
            log_p /= np.log(10)
            in_class = flat >= n_top
            log_p[in_class] -= class_size[flat[in_class] - n_top]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(np.add.reduceat(log_p, bounds[:-1]))], schema=schema)

    names = [f.name for f in kept]
    return coded.select("ids", *names).mapInArrow(run, "row long, doc_id long, n_tokens long, known long, base double, inner double, model double")


@dataclass
class Fitted:
    """What was learnt from the training documents, and all documents as arrays."""

    coded: DataFrame
    counts: DataFrame
    n_all: int
    v_all: int
    top: list[str]
    class_n: np.ndarray
    class_v: np.ndarray
    model: LogBilinear


def fit(slim: DataFrame, fold: int, held_out: int) -> Fitted:
    """``slim``: doc_id, text."""
    spark = slim.sparkSession
    trains = F.coalesce(bucket_of(F.col("doc_id"), fold) != held_out, F.lit(False))
    counts = materialize(word_counts(slim.where(trains)))
    totals = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).head()
    frequent = most_frequent(counts, FREQUENT)
    top = [w for w, _ in frequent[:TOP]]
    rest = counts.join(F.broadcast(spark.createDataFrame([(w,) for w in top], "word string")), "word", "left_anti")
    per_class = {r["k"]: (r["n"], r["v"]) for r in rest.groupBy(class_column(F.col("word")).alias("k")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()}
    class_n = np.array([per_class.get(k, (0, 0))[0] for k in range(CLASSES)], float)
    class_v = np.array([per_class.get(k, (0, 0))[1] for k in range(CLASSES)], float)
    common = spark.sparkContext.broadcast(([w for w, _ in frequent], [c for _, c in frequent]))
    coded = materialize(coded_documents(slim.select("doc_id", "text", trains.alias("trains")), len(top), common))
    shares = np.r_[[c for _, c in frequent[:TOP]], class_n] + 1.0
    model = train(coded, shares / shares.sum())
    return Fitted(coded, counts, int(totals["n"] or 0), int(totals["v"]), top, class_n, class_v, model)


def lm_scores(docs: DataFrame, fold: int = 7, held_out: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row."""
    small_batches(docs.sparkSession, 512)
    return scores_of(fit(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), fold, held_out), fold, held_out)


def scores_of(fitted: Fitted, fold: int, held_out: int) -> DataFrame:
    coded = fitted.coded
    tables = coded.sparkSession.sparkContext.broadcast(fitted.model.tables())
    scored = model_scores(coded, tables, np.log10(fitted.class_n + fitted.class_v + 1), len(fitted.top))
    pairs = coded.select("row", F.explode(F.arrays_zip("rare", "times")).alias("p")).select("row", F.col("p.rare").alias("word"), F.col("p.times").alias("times"))
    rarer = pairs.join(fitted.counts, "word").groupBy("row").agg(F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("more"), F.sum("times").alias("also"))
    joined = scored.join(rarer, "row", "left")
    more, also = F.coalesce("more", F.lit(0.0)), F.coalesce("also", F.lit(0))
    return joined.select(
        "doc_id",
        F.coalesce(bucket_of(F.col("doc_id"), fold) == held_out, F.lit(False)).alias("held_out"),
        "n_tokens",
        (F.col("known") + also).cast("long").alias("n_known"),
        F.lit(fitted.n_all).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * F.log10(F.lit(float(fitted.n_all + fitted.v_all + 1)))).alias("base_score"),
        (F.col("model") + F.col("inner") + more).alias("score"),
    )
