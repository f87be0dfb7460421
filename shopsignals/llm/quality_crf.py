"""Document quality from a linear-chain conditional random field over lines.

Every line gets a vector of surface statistics (``line_features``); the
emission scores of a line read its own vector and those of the lines before and
behind it, each statistic cut into bins at quantiles.  A two-state chain (bad,
good) with a transition matrix is trained in numpy by maximum conditional
likelihood on a bounded sample of labelled documents (``max_train`` lowest
hashes), whose lines all carry the document's label.  The forward-backward
recursion gives each line's marginal probability of *good*; the document's
score is their mean weighted by line length.

Whole texts are scored in one Arrow map; documents of a batch are stacked by
their number of lines, so the recursion is a matrix operation per line
position.  Lines of very long texts are all used.  No shuffle beyond the
broadcast of the bounded sample of labels.

Defined results: a null or empty text counts as one empty line and gets that
line's score; a null id is not held out and not trained on; null labels and
labels without a document are ignored, several labels of an id give the lowest;
without labels of both classes every score is the share of good labels (0
without labels); repeated rows give repeated rows; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsignals.llm.common import WORD_RE, arrow_rows, bucket_of, materialize, small_batches

THRESHOLD = 0.3
CUTS = 7
_SYMBOLS = re.compile(r"[#*$%&|<>{}\[\]\\^~=+_@]")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_DIGIT = re.compile(r"[0-9]")
_MARKS = re.compile(r"[.,;:]")
_LOUD = re.compile(r"[!?]")
#: frequent function words of the corpus' languages (a parameter)
STOP_WORDS = frozenset("the of and to a in is that for it le la les de des et un une est que der die das und den von zu el los las en y del".split())


def lines_of(text: str | None) -> list[str]:
    """Lines with a word; a text without any counts as one empty line."""
    return [x for x in text.split("\n") if x and not x.isspace()] if text and not text.isspace() else [""]


N_FEATURES = 13


def line_features(lines: list[str]) -> np.ndarray:
    """One row of statistics per line."""
    out = np.zeros((len(lines), N_FEATURES))
    seen: set = set()
    for i, line in enumerate(lines):
        words = WORD_RE.findall(line)
        n, chars = max(1, len(words)), max(1, len(line))
        follows = sum(map(str.__eq__, words, words[1:]))
        distinct = len(set(words))
        out[i] = (
            np.log1p(len(words)),
            sum(map(len, words)) / n,
            len(_UPPER.findall(line)) / chars,
            len(_DIGIT.findall(line)) / chars,
            len(_SYMBOLS.findall(line)) / n,
            len(_MARKS.findall(line)) / n,
            len(_LOUD.findall(line)) / n,
            line.rstrip()[-1:] in ".!?",
            sum(w in STOP_WORDS for w in words) / n,
            1 - distinct / n,
            follows / n,
            line in seen,
            max(map(len, words), default=0),
        )
        seen.add(line)
    return out


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def forward_backward(emit: np.ndarray, length: np.ndarray, trans: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Marginals [B, T, 2] and, given a weight per chain, expected transitions [2, 2] of padded chains."""
    size, steps, _ = emit.shape
    alpha, beta = np.zeros_like(emit), np.zeros_like(emit)
    alpha[:, 0] = emit[:, 0]
    inside = np.arange(steps)[None, :] < length[:, None]
    for t in range(1, steps):
        moved = _log_sum(alpha[:, t - 1, :, None] + trans[None], 1) + emit[:, t]
        alpha[:, t] = np.where(inside[:, t, None], moved, alpha[:, t - 1])
    for t in range(steps - 2, -1, -1):
        back = _log_sum(trans[None] + (emit[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        beta[:, t] = np.where(inside[:, t + 1, None], back, 0.0)
    log_z = _log_sum(alpha[:, -1], 1)
    marginal = np.exp(np.minimum(0.0, alpha + beta - log_z[:, None, None])) * inside[..., None]
    expected = np.zeros((2, 2))
    if weight is not None and steps > 1:
        joint = alpha[:, :-1, :, None] + trans + (emit[:, 1:] + beta[:, 1:])[:, :, None, :] - log_z[:, None, None, None]
        expected = np.einsum("btij,bt->ij", np.exp(np.minimum(0.0, joint)), inside[:, 1:] * weight[:, None])
    return marginal, expected


@dataclass
class Crf:
    cuts: np.ndarray  # [features, CUTS]
    weights: np.ndarray  # [3 * features * (CUTS + 1) + 1, 2]
    trans: np.ndarray  # [2, 2]
    constant: float | None = None

    def indices(self, features: np.ndarray) -> np.ndarray:
        """Active inputs of each line: bins of its own, the previous and the next line, and the bias."""
        bins = np.stack([np.searchsorted(self.cuts[k], features[:, k], side="left") for k in range(features.shape[1])], 1)
        width = self.cuts.shape[1] + 1
        own = bins + np.arange(features.shape[1]) * width
        block = features.shape[1] * width
        missing = 3 * block + 1  # its weight is fixed at zero
        before, behind = np.full_like(own, missing), np.full_like(own, missing)
        before[1:], behind[:-1] = own[:-1] + block, own[1:] + 2 * block
        return np.concatenate([own, before, behind, np.full((len(own), 1), 3 * block)], 1)

    def emissions(self, indices: np.ndarray) -> np.ndarray:
        return np.vstack([self.weights, np.zeros((1, 2))])[indices].sum(-2)


def batches_by_lines(lengths: np.ndarray, cells: int = 60_000):
    """Groups of documents of similar length with a bounded number of padded cells."""
    order = np.argsort(lengths, kind="stable")
    begin = 0
    while begin < len(order):
        end = begin + 1
        while end < len(order) and lengths[order[end]] * (end + 1 - begin) <= cells and lengths[order[end]] <= 1.5 * lengths[order[begin]] + 2:
            end += 1
        yield order[begin:end]
        begin = end


def _padded(parts: list[np.ndarray], fill=0.0) -> tuple[np.ndarray, np.ndarray]:
    length = np.array([len(p) for p in parts])
    out = np.full((len(parts), length.max(), *parts[0].shape[1:]), fill, parts[0].dtype)
    for i, p in enumerate(parts):
        out[i, : len(p)] = p
    return out, length


def fit(features: list[np.ndarray], good: np.ndarray, steps: int = 50, l2: float = 1e-3) -> Crf:
    """Maximum conditional likelihood by Adam; a document weighs 1 whatever its number of lines."""
    stacked = np.concatenate(features)
    cuts = np.quantile(stacked, np.linspace(0, 1, CUTS + 2)[1:-1], axis=0).T.copy()
    block = stacked.shape[1] * (CUTS + 1)
    model = Crf(cuts, np.zeros((3 * block + 1, 2)), np.zeros((2, 2)))
    inputs = [model.indices(f) for f in features]
    lengths = np.array([len(f) for f in features])
    groups = [(g, *_padded([inputs[i] for i in g], 3 * block + 1)) for g in batches_by_lines(lengths)]
    params = [model.weights, model.trans]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    share = np.where(good > 0, 0.5 / max(good.mean(), 1e-9), 0.5 / max(1 - good.mean(), 1e-9)) / len(good)
    for step in range(1, steps + 1):
        grads = [l2 * p for p in params]
        for g, idx, length in groups:
            emit = model.emissions(idx)
            per_line = share[g] / length
            marginal, moves = forward_backward(emit, length, model.trans, per_line)
            inside = np.arange(idx.shape[1])[None] < length[:, None]
            weight = per_line[:, None, None] * inside[..., None]
            label = np.stack([1 - good[g], good[g]], -1)[:, None, :]
            error = (marginal - label * inside[..., None]) * weight
            flat = idx.reshape(-1, idx.shape[2])
            for s in range(2):
                grads[0][:, s] += np.bincount(flat.ravel(), np.repeat(error[..., s].ravel(), idx.shape[2]), 3 * block + 2)[: 3 * block + 1]
            # expected minus observed moves: a document's lines all carry its label
            stay = per_line * (length - 1)
            grads[1] += moves - np.diag([stay[good[g] == 0].sum(), stay[good[g] == 1].sum()])
        for p, d, m, v in zip(params, grads, first, second):
            m += 0.1 * (d - m)
            v += 0.01 * (d * d - v)
            p -= 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return model


def scores(model: Crf, texts: list[str | None]) -> np.ndarray:
    """Length-weighted mean of the lines' marginal probability of *good*."""
    if model.constant is not None:
        return np.full(len(texts), model.constant)
    lines = [lines_of(t) for t in texts]
    counts = np.array([len(x) for x in lines])
    inputs = [model.indices(line_features(x)) for x in lines]
    out = np.zeros(len(texts))
    for g in batches_by_lines(counts):
        emit, length = _padded([model.emissions(inputs[i]) for i in g])
        marginal, _ = forward_backward(emit, length, model.trans)
        weight, _ = _padded([np.array([max(1, len(x)) for x in lines[i]], float) for i in g])
        out[g] = (marginal[..., 1] * weight).sum(1) / weight.sum(1)
    return np.clip(out, 0.0, 1.0)


SAMPLE = pa.schema([("good", pa.int32()), ("n", pa.int32()), ("features", pa.list_(pa.float32()))])


def train(docs: DataFrame, label_rows: DataFrame, fold: int = 5, held_out: int = 0, max_train: int = 3_000, max_lines: int = 5_000) -> Crf:
    """``docs``: doc_id, text.  ``label_rows``: doc_id, quality.

    At most ``max_train`` rows are used; texts of more than ``max_lines`` lines are
    scored but not learnt from, so that no text is too large for the driver.
    """
    usable = label_rows.where(F.col("quality").isin(0, 1) & (bucket_of(F.col("doc_id"), fold) != held_out))
    sample = usable.groupBy("doc_id").agg(F.min("quality").cast("int").alias("good")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    # bounded by max_train, so it can be broadcast
    taken = materialize(docs.join(F.broadcast(sample), "doc_id").select("text", "good"))

    def run(batches):
        for b in batches:
            lines = [lines_of(t) for t in b.column(0).to_pylist()]
            taken = [(g, line_features(x)) for g, x in zip(b.column(1).to_pylist(), lines) if len(x) <= max_lines]
            yield arrow_rows(SAMPLE, {"good": [g for g, _ in taken], "n": [len(p) for _, p in taken], "features": [p.ravel() for _, p in taken]})

    rows = taken.mapInArrow(run, "good int, n int, features array<float>").collect()
    good = np.array([r["good"] for r in rows], float)
    if len(rows) == 0 or good.min() == good.max():
        return Crf(np.zeros((0, 0)), np.zeros((0, 2)), np.zeros((2, 2)), float(good.mean()) if len(rows) else 0.0)
    order = sorted(range(len(rows)), key=lambda i: (rows[i]["n"], rows[i]["good"], rows[i]["features"][:N_FEATURES]))
    return fit([np.array(rows[i]["features"], float).reshape(-1, N_FEATURES) for i in order], good[order])


SCORED = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def quality(docs: DataFrame, label_rows: DataFrame, fold: int = 5, held_out: int = 0, **options) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``."""
    small_batches(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = train(slim, label_rows.select("doc_id", "quality"), fold, held_out, **options)

    def run(batches):
        for b in batches:
            yield arrow_rows(SCORED, {"doc_id": b.column(0), "score": scores(model, b.column(1).to_pylist())})

    return slim.mapInArrow(run, "doc_id long, score double").select(
        "doc_id",
        F.coalesce(bucket_of(F.col("doc_id"), fold) == held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
