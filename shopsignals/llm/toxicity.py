"""Toxicity classifier regularised by counterfactual sentences.

Features of a text are the sets of its lower-cased words and of their prefixes
of 3 to 7 letters.  Training takes a bounded sample of labelled rows
(``max_train``, lowest hashes of distinct texts); Spark counts how often each
feature occurs in toxic and other texts of the sample, the strongest
``max_features`` and all identity features stay, and numpy fits a logistic
model with an L1 penalty by proximal gradient steps.

Counterfactuals: every sentence of the sample that names a group gets two copies
in which the identity term is swapped for another one of its category and for
a word that names no group; the
penalty ``fairness * mean((score(sentence) - score(copy))^2)`` on the linear
scores joins the loss.  Terms that only co-occur with toxic labels thus lose
their weight, and neutral mentions of a group stay clean.

Scoring is one Arrow map over whole texts, without a shuffle; the model that is
sent along has at most ``max_features`` weights plus the identity terms.

Defined results: a null or empty text scores as a text without features; a
null id is not held out and never trained on; null labels, labels without a
document and rows of other columns are ignored; an id with several labels is
toxic if one of them says so; without labels of both classes every score is
the share of toxic labels (0 without labels); repeated rows give repeated
rows; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from shopsignals.llm.common import arrow_rows, bucket_of, materialize, small_batches, unused

THRESHOLD = 0.3
PREFIXES = (3, 4, 5, 6, 7)
_TOKEN = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[^.!?\n]+")

#: identity terms by category, in the four languages of the corpus (a parameter)
IDENTITY_TERMS = {
    "gender": "woman women man men girl girls boy boys femme femmes homme hommes frau frauen mann männer mujer mujeres hombre hombres",
    "religion": "muslim muslims christian christians jewish jews hindu hindus buddhist buddhists musulmans chrétiens juifs muslime christen juden musulmanes cristianos judíos",
    "origin": "african africans asian asians american americans european europeans mexican mexicans african-american immigrants refugees immigrés réfugiés einwanderer flüchtlinge inmigrantes refugiados",
    "orientation": "gay lesbian bisexual transgender straight heterosexual homosexual",
    "age and body": "old young elderly disabled blind deaf",
}


def words_of(text: str | None) -> set[str]:
    return set(_TOKEN.findall(text.lower())) if text else set()


def features_of(words: set[str]) -> set[str]:
    """``word`` as ``=word`` and its prefixes as ``^pre``."""
    found = {"=" + w for w in words}
    for w in words:
        n = len(w)
        for k in PREFIXES:
            if n <= k:
                break
            found.add("^" + w[:k])
    return found


def swaps(text: str | None, categories: dict[str, list[str]]) -> list[tuple[set[str], set[str]]]:
    """(features, features after the swap) of each sentence that names a group."""
    if not text:
        return []
    out = []
    for sentence in _SENTENCE.findall(text.lower()):
        words = set(_TOKEN.findall(sentence))
        for terms in categories.values():
            for named in words.intersection(terms):
                other = terms[(terms.index(named) + 1 + len(words) % max(1, len(terms) - 1)) % len(terms)]
                rest = words - {named}
                # another group, and no group in particular
                out += [(features_of(words), features_of(rest | {other})), (features_of(words), features_of(rest))]
    return out


@dataclass
class Model:
    bias: float
    weights: dict[str, float] = field(default_factory=dict)

    def score(self, text: str | None, cache: dict) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.linear(words_of(text), cache), -30, 30))))

    def linear(self, words: set[str], cache: dict) -> float:
        weights, hit = self.weights, {}
        for w in words:
            known = cache.get(w)
            if known is None:
                known = cache[w] = tuple((f, weights[f]) for f in features_of({w}) if f in weights)
            if known:
                hit.update(known)
        return self.bias + sum(hit.values())


def _sparse(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    return owner, np.array([c for r in rows for c in r], np.int64)


def fit_logistic(rows: list[list[int]], target: np.ndarray, n_features: int, pairs: list[tuple[list[int], list[int]]], fairness: float, l1: float = 2e-4, steps: int = 400) -> tuple[float, np.ndarray]:
    """Accelerated proximal gradient on log loss + counterfactual penalty + L1."""
    owner, cols = _sparse(rows)
    n = len(rows)
    a_owner, a_cols = _sparse([a for a, _ in pairs])
    b_owner, b_cols = _sparse([b for _, b in pairs])
    diff = lambda w: np.bincount(a_owner, w[a_cols], len(pairs)) - np.bincount(b_owner, w[b_cols], len(pairs))
    w, bias = np.zeros(n_features), np.log(max(target.mean(), 1e-6) / max(1 - target.mean(), 1e-6))
    # Lipschitz bound of the gradient by power iteration on the data, plus the penalty
    v = np.ones(n_features) / np.sqrt(max(n_features, 1))
    for _ in range(12):
        u = np.bincount(cols, np.bincount(owner, v[cols], n)[owner], n_features) / (4 * n)
        if pairs:
            d = diff(v)
            u += 2 * fairness / len(pairs) * (np.bincount(a_cols, d[a_owner], n_features) - np.bincount(b_cols, d[b_owner], n_features))
        size = np.linalg.norm(u)
        v = u / max(size, 1e-12)
    rate = 1.0 / (1.3 * size + 0.25)
    look, last, t = w.copy(), w, 1.0
    for _ in range(steps):
        z = bias + np.bincount(owner, look[cols], n)
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - target
        grad = np.bincount(cols, error[owner], n_features) / n
        if pairs:
            d = diff(look)
            grad += 2 * fairness / len(pairs) * (np.bincount(a_cols, d[a_owner], n_features) - np.bincount(b_cols, d[b_owner], n_features))
        bias -= 2.0 * error.mean()
        stepped = look - rate * grad
        w = np.sign(stepped) * np.maximum(np.abs(stepped) - rate * l1, 0.0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look, last, t = w + (t - 1) / t2 * (w - last), w, t2
    return float(bias), w


FEATURE_ROWS = pa.schema([("feature", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])
ROWS = pa.schema([("toxic", pa.int32()), ("features", pa.list_(pa.int32())), ("pairs", pa.list_(pa.list_(pa.list_(pa.int32()))))])


def train(docs: DataFrame, label_rows: DataFrame, fold: int = 4, held_out: int = 2, max_train: int = 12_000, max_features: int = 4_000, min_count: int = 4, fairness: float = 5.0, identity_terms=None, max_pairs: int = 256) -> Model:
    """``docs``: doc_id, text.  ``label_rows``: doc_id, toxic.

    At most ``max_train`` rows are used, and of each at most ``max_pairs`` swapped
    sentences (lowest hashes), so a very long text stays small on the driver.
    """
    categories = {k: v.split() if isinstance(v, str) else list(v) for k, v in (identity_terms or IDENTITY_TERMS).items()}
    usable = label_rows.where((F.col("toxic").isin(0, 1)) & (bucket_of(F.col("doc_id"), fold) != held_out))
    sample = (
        usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    )
    # the sample's size is bounded by max_train, so it can be broadcast
    taken = docs.join(F.broadcast(sample), "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"))
    taken = materialize(taken.dropDuplicates(["text", "toxic"]))

    def count(batches):
        seen: dict = {}
        for b in batches:
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for f in features_of(words_of(text)):
                    c = seen.get(f)
                    if c is None:
                        c = seen[f] = [0, 0]
                    c[1 - toxic] += 1
            if len(seen) > 300_000:
                yield arrow_rows(FEATURE_ROWS, {"feature": list(seen), "toxic": [c[0] for c in seen.values()], "clean": [c[1] for c in seen.values()]})
                seen = {}
        if seen:
            yield arrow_rows(FEATURE_ROWS, {"feature": list(seen), "toxic": [c[0] for c in seen.values()], "clean": [c[1] for c in seen.values()]})

    classes = {r["toxic"]: r["n"] for r in taken.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = classes.get(1, 0), classes.get(0, 0)
    if not n_toxic or not n_clean:
        share = n_toxic / max(1, n_toxic + n_clean)
        return Model(float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))
    counted = taken.mapInArrow(count, "feature string, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    rate_t, rate_c = (F.col("t") + 0.5) / (n_toxic + 1), (F.col("c") + 0.5) / (n_clean + 1)
    z = F.log(rate_t / rate_c) / F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
    terms = {t for v in categories.values() for t in v}
    identity = features_of(terms)
    strongest = counted.where(F.col("t") + F.col("c") >= min_count).withColumn("z", z).orderBy(F.abs("z").desc(), "feature").limit(max_features)
    names = sorted({r["feature"] for r in strongest.select("feature").collect()} | identity)
    index = {f: i for i, f in enumerate(names)}

    def vectors(batches):
        for b in batches:
            out = {"toxic": b.column(1), "features": [], "pairs": []}
            for text in b.column(0).to_pylist():
                out["features"].append(sorted(index[f] for f in features_of(words_of(text)) if f in index))
                pairs = [[sorted(index[f] for f in side if f in index) for side in pair] for pair in swaps(text, categories)]
                out["pairs"].append(pairs if len(pairs) <= max_pairs else sorted(pairs, key=lambda p: zlib.crc32(repr(p).encode()))[:max_pairs])
            yield arrow_rows(ROWS, out)

    rows = taken.mapInArrow(vectors, "toxic int, features array<int>, pairs array<array<array<int>>>").collect()
    pairs = [(list(p[0]), list(p[1])) for r in rows for p in r["pairs"]]
    bias, w = fit_logistic([list(r["features"]) for r in rows], np.array([r["toxic"] for r in rows], float), len(names), pairs, fairness)
    return Model(bias, {f: float(x) for f, x in zip(names, w) if abs(x) > 1e-6})


SCORED = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def score(docs: DataFrame, model: Model, keep: str | None = None) -> DataFrame:
    """``doc_id, score`` per row; with ``keep`` every column of ``docs`` and the score under this name."""
    small_batches(docs.sparkSession)
    text_at = docs.columns.index("text")

    def run(batches):
        cache: dict = {}
        for b in batches:
            if len(cache) > 400_000:
                cache.clear()
            scores = [model.score(t, cache) for t in b.column(text_at).to_pylist()]
            if keep:
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64())], names=[*b.schema.names, "score"])
            else:
                yield arrow_rows(SCORED, {"doc_id": b.column(0), "score": scores})

    if not keep:
        return docs.mapInArrow(run, "doc_id long, score double")
    # columns go to the tasks by number: any name is allowed
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return plain.mapInArrow(run, StructType([*plain.schema.fields, StructField("score", DoubleType())])).toDF(*docs.columns, keep)


def toxicity(docs: DataFrame, label_rows: DataFrame, fold: int = 4, held_out: int = 2, **options) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    small_batches(docs.sparkSession)
    model = train(slim, label_rows.select("doc_id", "toxic"), fold, held_out, **options)
    return score(slim, model).select(
        "doc_id",
        F.coalesce(bucket_of(F.col("doc_id"), fold) == held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, label_rows: DataFrame, **options) -> DataFrame:
    """The documents that the classifier does not reject, with their columns."""
    small_batches(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = train(slim, label_rows.select("doc_id", "toxic"), **options)
    (name,) = unused(docs.columns, "score")
    return score(docs, model, keep=name).where(F.col(name) < THRESHOLD).drop(name)
