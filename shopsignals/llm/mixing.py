"""Mixing sources to target weights by pivotal dependent rounding.

Each source should fill ``target`` words, so each of its documents should be
taken ``target / source_size`` times.  Whole copies are certain; the fraction
is rounded by pivotal pairing: two fractional partners exchange words (the
one's probability times size rises by what the other's falls) until one of
them is taken or not taken for certain.  The direction is drawn so that
the expected words of both stay, and every exchange keeps the sum of words, so a source ends
within one document of its target, mostly a short one.

The pairing runs as a distributed reduction tree.  Documents are hashed into
small buckets of a source; a fold over each bucket's array pairs each document
with the pool of the shorter ones behind it and settles all but one; those left
form the next level's buckets, until one per source is left, which is drawn.
All levels are DataFrame functions; a bucket holds about ``fan_in`` documents
whatever the source's size, so a source with a third of all rows has just more
buckets.  The draws are hashes of row, copy number and seed, so reruns agree.

Defined results: null or empty texts have size 0 and are taken 0 times; a null
source is a source of its own, last in order; with no words at all every target
is 0; a null id is treated as an id of its own; rows that repeat an id are
documents of their own.  Rows are told apart by a hash of all their columns, so
equal rows are interchangeable and the result does not depend on their order.
Other columns, whatever their names, are ignored, or returned unchanged by
``mixed_documents``.

A document's partner is the pool of the shorter documents behind it, whose
probabilities move together; where they are equal, as those of a source are at
first, each document's own expectation stays too.  It is not one of them alone:
in a pair of unequal sizes the shorter one always settles first, so a fold
over pairs would leave the longest document of a source to the last rounding,
and a source off its target by as much.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsignals.llm.common import materialize, quoted, unused
from shopsignals.operators.running import global_rank

WEIGHTS = (5.0, 2.0, 1.0)


def word_count(text: Column) -> Column:
    """Words of a text: separators become spaces, and the pieces that are not empty count."""
    text = F.coalesce(text, F.lit(""))
    for c in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.size(F.array_remove(F.split(text, " ", -1), "")).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, max_repeat: float = 3.0) -> DataFrame:
    """``source, source_size`` plus ``target``: shares by weight, at most ``max_repeat`` times the size.

    Sources at their limit keep it and the rest is shared anew by weight, until
    no share is above its limit.  Each round is one aggregate over the table of
    sources; sources are ranked by distributed running totals, so their number
    does not matter.
    """
    named = materialize(sources.select("source", "source_size"))
    ranked = global_rank(named.where("source IS NOT NULL").select("source"), "source", "at")
    some = named.where("source IS NOT NULL").join(ranked, "source").select("source", "source_size", "at")
    last = named.where("source IS NULL").select("source", "source_size", F.lit(named.count()).cast("long").alias("at"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.col("at") - 1, F.lit(len(weights))) + 1).cast("int"))
    d = materialize(some.unionByName(last).select("source", "source_size", w.alias("w"), (F.col("source_size") * F.lit(float(max_repeat))).alias("cap")))
    total, weight = d.agg(F.sum("source_size"), F.sum("w")).head()
    left, open_weight, full = float(total or 0), weight or 0.0, 0
    while open_weight:
        over = F.lit(left) * F.col("w") / F.lit(open_weight) > F.col("cap")
        filled, n, rest = d.agg(F.sum(F.when(over, F.col("cap"))), F.count(F.when(over, 1)), F.sum(F.when(~over, F.col("w")))).head()
        if n == full:
            break
        full, left, open_weight = n, float(total) - (filled or 0.0), rest or 0.0
    share = F.lit(left) * F.col("w") / F.lit(open_weight) if open_weight else F.lit(float("inf"))
    return d.select("source", "source_size", F.least(F.col("cap"), share).alias("target"))


def _uniform(seed: int, *cols: Column) -> Column:
    """A number in (0, 1) fixed by its arguments."""
    h = F.xxhash64(*cols, F.lit(seed))
    return (F.pmod(h, F.lit(1 << 52)).cast("double") + 0.5) / F.lit(float(1 << 52))


def _settle(items: Column, words: Column, mass: Column, seed: int) -> Column:
    """Fold of an array of (size, key, p), long documents first: settled documents and the one left.

    ``words`` and ``mass`` are the sums of ``size`` and ``p * size``.  The
    partner of a document is the pool of those behind it, whose probabilities
    move together: ``p`` becomes ``scale * p + shift``.  The exchange settles
    the document, or the whole pool (all 0 or all 1) and leaves the document.
    So what is left is the shortest document of a bucket, unless a long one
    outweighs the rest.
    """
    none = F.struct(F.lit(None).cast("long").alias("size"), F.lit(None).cast("long").alias("key"), F.lit(None).cast("double").alias("p"))
    start = F.struct(
        words.cast("double").alias("words"), mass.alias("mass"), F.lit(1.0).alias("scale"), F.lit(0.0).alias("shift"),
        none.alias("left"), F.array().cast("array<struct<key:long,up:boolean>>").alias("done"),
    )
    tiny = 1e-9

    def step(a, x):
        p = F.greatest(F.lit(0.0), F.least(F.lit(1.0), a["scale"] * x["p"] + a["shift"]))
        words_behind = a["words"] - x["size"]
        mass_behind = a["mass"] - x["p"] * x["size"]  # at the first probabilities
        pool = F.greatest(F.lit(0.0), F.least(words_behind, a["scale"] * mass_behind + a["shift"] * words_behind))
        room = words_behind - pool
        gain_words = F.least((F.lit(1.0) - p) * x["size"], pool)
        lose_words = F.least(p * x["size"], room)
        total = gain_words + lose_words
        gains = _uniform(seed, x["key"]) * total < lose_words
        after = F.when(gains, p + gain_words / x["size"]).otherwise(p - lose_words / x["size"])
        falls = F.when(gains & (pool > 0), gain_words / pool).otherwise(0.0)
        rises = F.when(~gains & (room > 0), lose_words / room).otherwise(0.0)
        keep = (F.lit(1.0) - falls) * (F.lit(1.0) - rises)
        settled = (after < tiny) | (after > 1 - tiny)
        return F.struct(
            words_behind.alias("words"), mass_behind.alias("mass"),
            (a["scale"] * keep).alias("scale"), (a["shift"] * keep + rises).alias("shift"),
            F.when(settled, a["left"]).otherwise(F.struct(x["size"].alias("size"), x["key"].alias("key"), after.alias("p"))).alias("left"),
            F.when(settled, F.concat(a["done"], F.array(F.struct(x["key"].alias("key"), (after > 0.5).alias("up")))))
            .otherwise(a["done"]).alias("done"),
        )

    return F.aggregate(items, start, step, lambda a: F.struct(a["left"].alias("left"), a["done"].alias("done")))


def pivotal(items: DataFrame, largest: int, fan_in: int = 64, seed: int = 0) -> DataFrame:
    """Settled ``(group, key, up)`` of ``(group, key, size, p)`` with unique keys and 0 < p < 1.

    ``largest`` is the number of rows of the largest group.
    """
    levels = max(1, math.ceil(math.log(max(largest, 2)) / math.log(fan_in)))
    settled, rest = None, items
    for level in range(levels, 0, -1):
        # at the last level one bucket per group is left
        buckets = fan_in ** (level - 1)
        item = F.struct("size", "key", "p")
        gathered = rest.groupBy("group", F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(buckets)).alias("bucket")).agg(
            F.sort_array(F.collect_list(item), asc=False).alias("items"),
            F.sum("size").alias("words"),
        )
        # summed in the order of the array, so that reruns agree to the last bit
        mass = F.aggregate("items", F.lit(0.0), lambda a, x: a + x["p"] * x["size"])
        folded = gathered.withColumn("mass", mass).select("group", _settle(F.col("items"), F.col("words"), F.col("mass"), seed + level).alias("s"))
        folded = materialize(folded.select("group", "s.*"))
        done = folded.select("group", F.explode("done").alias("d")).select("group", "d.key", "d.up")
        settled = done if settled is None else settled.unionByName(done)
        rest = folded.where("left.key IS NOT NULL").select("group", "left.key", "left.size", "left.p")
    # the last one has no partner: it is drawn by its probability, so expectations stay
    last = rest.select("group", "key", (_uniform(seed, F.col("key"), F.lit("last")) < F.col("p")).alias("up"))
    return settled.unionByName(last)


#: equal rows that one step numbers
RUN = 4096


def _numbered(rows: DataFrame, counted: str) -> DataFrame:
    """Each row as often as ``counted`` says, with ``n`` from 0; a large count is spread over tasks in runs."""
    runs = rows.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(counted) - 1) / RUN))))
    many = runs.where(F.col(counted) > RUN).repartition("h", "run").unionByName(runs.where(F.col(counted) <= RUN))
    inside = F.sequence(F.col("run") * RUN, F.least(F.col("run") * RUN + RUN, F.col(counted)) - 1)
    return many.withColumn("n", F.explode(inside)).drop("run")


def _row_hash(docs: DataFrame) -> Column:
    """A hash of a whole row: rows that share it are taken for equal."""
    return F.xxhash64(*[F.col(quoted(f.name)) for f in docs.schema if f.dataType.typeName() not in ("map", "variant")])


def copies(docs: DataFrame, weights=WEIGHTS, max_repeat: float = 3.0, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``h, doc_id, source, size, source_size, target, copies`` per row; ``h`` is the row's hash.

    Equal rows are counted once and numbered afterwards, so a hot id or text is
    never sorted, and what is taken does not depend on the partitioning.
    """
    sized = docs.select(
        F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(source_col)).alias("source"), word_count(F.col(quoted(text_col))).alias("size"), _row_hash(docs).alias("h"),
    )
    kinds = materialize(sized.groupBy("h", "doc_id", "source", "size").agg(F.count(F.lit(1)).alias("m")))
    by_source = kinds.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"), F.sum("m").alias("rows"))
    by_source = materialize(by_source)
    per_source = targets(by_source, weights, max_repeat).withColumnRenamed("source", "of")
    largest = by_source.agg(F.max("rows")).head()[0] or 0
    rows = materialize(_numbered(kinds, "m").select("h", "doc_id", "source", "size", F.xxhash64("h", "doc_id", "source", "size", "n").alias("key")))
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = rows.join(per_source, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    joined = joined.withColumns({"whole": F.floor(share + 1e-9).cast("long"), "p": share - F.floor(share + 1e-9)})
    fractional = joined.where((F.col("size") > 0) & (F.col("p") > 1e-9))
    chosen = pivotal(fractional.select(F.struct("source").alias("group"), "key", "size", "p"), largest, seed=seed)
    up = joined.join(chosen.where("up").select("key", F.lit(1).cast("long").alias("extra")), "key", "left")
    return up.select(
        "h", "doc_id", "source", "size", "source_size", "target",
        F.when(F.col("size") > 0, F.col("whole") + F.coalesce("extra", F.lit(0).cast("long"))).otherwise(F.lit(0).cast("long")).alias("copies"),
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``."""
    return copies(docs, **options).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document repeated as often as it is taken, with its columns.

    Only hashes and sizes take part in the mixing; texts join the result once.
    """
    names = [quoted(c) for c in docs.columns]
    h, times, n = unused(docs.columns, "h", "times", "n")
    taken = materialize(copies(docs, **options).groupBy("h").agg(F.sum("copies").alias("times"), F.count(F.lit(1)).alias("m")).where("times > 0"))
    whole = docs.withColumn(h, _row_hash(docs))
    single = whole.join(taken.where("m = 1").select(F.col("h").alias(h), F.col("times").alias(times)), h)
    out = single.withColumn(n, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times)))).select(names)
    repeated = taken.where("m > 1").select("h", "times")
    if not repeated.limit(1).count():
        return out
    # of equal rows one is kept and repeated
    row = F.struct(*[F.col(c) for c in names])
    kept = whole.join(repeated.select(F.col("h").alias(h)), h, "left_semi").groupBy(F.col(h).alias("h")).agg(F.first(row).alias("row"))
    return out.unionByName(_numbered(kept.join(repeated, "h"), "times").select("row.*"))
