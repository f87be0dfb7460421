"""Near-duplicate vectors from an NN-descent neighbour graph.

Equal vectors are one class with a count; only classes go on.

1. *Start*: ``TABLES`` tables of random-hyperplane buckets.  A bucket that
   holds too many classes takes more hyperplanes, so no task gets an unbounded
   one.  Inside a bucket blocks of vectors are multiplied, and each vector
   takes its ``k`` best.
2. *NN-descent*: at every node the neighbours (and reverse neighbours, the
   closest ``2 k``) are compared with each other; better ones enter the lists.
   Rounds go on until fewer than ``SETTLED`` of the entries change.
3. *Enlarging*: a list is saturated when all its ``k`` entries reach the
   threshold; others may be missing from it.  Such a list takes everything in
   its component of threshold edges, and ``k`` further entries from outside of
   that component: buckets (with new hyperplanes) and rounds are run again in
   which a vector looks for others than those of its component.  Entries that
   reach the threshold join components; lists whose further entries all reach
   it are enlarged again, until the last entry of every list is below it.
4. *Counting*: the list of a vector is then its component, which is compared
   completely, cut into blocks of ``BLOCK`` vectors whose pairs are spread over
   tasks; a pair of blocks emits counts per vector, not pairs.
5. *Audit*: ``audit`` vectors (lowest hashes, more while fewer than
   ``ENOUGH`` of them have one or two linked vectors, at most ``QUERIES``) are
   compared with all rows.  Each has a share of its links that the graph found.
   Vectors are put in classes by their number of linked vectors (1 to 2, 3 to 5,
   6 to 10, then doubling); if the mean share of any class is below ``recall``,
   another start with new hyperplanes joins the graph and 2 to 5 run again, at
   most ``RETRIES`` times.  If the audit still fails, all vectors are compared
   with all, ``CHUNK`` at a time.

Cosines are computed in double precision and every link that counts was
computed so.  Defined results: vectors that are null, empty, zero, or hold null
or non-finite components, and those of another length than most, link with
nothing; rows that repeat an id are separate vectors with that id; a null id
never becomes a component id while the group has another; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopsignals.llm.common import arrow_rows, materialize, stream_groups
from shopsignals.llm.components import components

TABLES = 10
BUCKET = 400
BLOCK = 512
SETTLED = 0.002
RETRIES = 3
ENOUGH = 100
QUERIES = 3500
CHUNK = 4096
EDGES = pa.schema([("id", pa.int64()), ("nbr", pa.int64()), ("sim", pa.float64())])


def _matrix(column) -> np.ndarray:
    """Unit rows in double precision of an Arrow list column."""
    flat = np.asarray(column.flatten(), np.float64)
    x = flat.reshape(len(column), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def vector_classes(vectors: DataFrame) -> DataFrame:
    """``cls, first_id, n, v``: one row per different usable vector."""
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = vectors.where(F.col("v").isNotNull()).where((F.size("v") > 0) & finite).where(norm > 0)
    most = usable.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1).head()
    usable = usable.where(F.size("v") == (most["d"] if most else 0))
    grouped = usable.groupBy("v").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    return grouped.select(F.xxhash64("v").alias("cls"), "first_id", "n", "v")


def _sorted_by(df: DataFrame, key: str, *more: str) -> DataFrame:
    return df.repartition(key).sortWithinPartitions(key, *more)


def start_graph(classes: DataFrame, n: int, dim: int, k: int, seed: int) -> DataFrame:
    """Edges ``id, nbr, sim`` from hyperplane buckets of ``cls, v, grp, seeks``.

    Vectors that ``seeks`` marks look for the ``k`` closest of other ``grp``.
    """
    bits = max(1, math.ceil(math.log2(max(2, n / 50))))
    planes = np.random.default_rng(seed).standard_normal((TABLES, bits + 24, dim))

    def codes(batches):
        for b in batches:
            x = _matrix(b.column(1))
            sign = np.einsum("nd,tpd->ntp", x, planes) > 0
            weight = 1 << np.arange(bits, dtype=np.int64)
            more = 1 << np.arange(24, dtype=np.int64)
            code, extra = sign[:, :, :bits] @ weight, sign[:, :, bits:] @ more
            rows = np.repeat(np.arange(len(x)), TABLES)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows)), pa.array(np.tile(np.arange(TABLES, dtype=np.int64), len(x))), pa.array(code.ravel()), pa.array(extra.ravel())],
                names=["cls", "t", "code", "extra"],
            )

    coded = materialize(classes.select("cls", "v").mapInArrow(codes, "cls long, t long, code long, extra long"))
    size = coded.groupBy("t", "code").agg(F.count(F.lit(1)).alias("m"))
    # a bucket over the bound takes as many further bits as halve it to the bound
    need = F.greatest(F.lit(0.0), F.ceil(F.log2(F.col("m") / F.lit(float(BUCKET))))).cast("int")
    fine = F.least(need, F.lit(24))
    keyed = coded.join(size.withColumn("fine", fine), ["t", "code"]).select(
        "cls", F.xxhash64("t", "code", F.col("extra") % F.expr("shiftleft(1L, fine)"), F.lit(seed)).alias("bucket")
    )

    def pairs(batches):
        def best(table):
            every, x = table.column(1).to_numpy(), _matrix(table.column(4).combine_chunks())
            groups, seeks = table.column(2).to_numpy(), np.asarray(table.column(3).to_numpy(), bool)
            for lo in range(0, len(every), 2 * BUCKET):
                cut = slice(lo, lo + 2 * BUCKET)
                i, m, of = every[cut], x[cut], groups[cut]
                who = np.flatnonzero(seeks[cut])
                if len(i) < 2 or not len(who):
                    continue
                sim = m[who] @ m.T
                sim[of[who][:, None] == of[None, :]] = -2
                take = min(k, len(i) - 1)
                near = np.argpartition(-sim, take - 1, axis=1)[:, :take]
                best = np.take_along_axis(sim, near, 1).ravel()
                real = best > -2
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(i[who], take)[real]), pa.array(i[near.ravel()][real]), pa.array(best[real])], schema=EDGES)

        yield from stream_groups(batches, best)

    # a bucket still over the bound is sliced in an order of its own, so each table has other slices
    rows = keyed.join(classes.select("cls", "grp", "seeks", "v"), "cls").select("bucket", "cls", "grp", "seeks", "v", F.xxhash64("cls", "bucket").alias("order"))
    return _sorted_by(rows, "bucket", "order").mapInArrow(pairs, "id long, nbr long, sim double")


def _best(edges: DataFrame, k: int) -> DataFrame:
    """The ``k`` closest different neighbours of each node; ``fresh`` 1 where none of the old entries had it."""
    one = edges.groupBy("id", "nbr").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("sim"), "nbr"))
    return one.withColumn("r", rank).where(F.col("r") <= k).drop("r")


def descend(graph: DataFrame, classes: DataFrame, k: int, rounds: int) -> DataFrame:
    """NN-descent rounds on ``id, nbr, sim``; vectors of one ``grp`` are no neighbours of each other."""
    graph = materialize(_best(graph.withColumn("fresh", F.lit(0)), k))
    for _ in range(rounds):
        both = graph.select("id", "nbr", "sim").unionByName(graph.select(F.col("nbr").alias("id"), F.col("id").alias("nbr"), "sim"))
        near = _best(both.withColumn("fresh", F.lit(0)), 2 * k).select("id", "nbr")
        worst = graph.groupBy("id").agg(F.min("sim").alias("worst"), F.count(F.lit(1)).alias("m"))
        worst = worst.select(F.col("id").alias("nbr"), F.when(F.col("m") < k, F.lit(-2.0)).otherwise(F.col("worst")).alias("worst"))
        vectors = classes.select(F.col("cls").alias("nbr"), "grp", "v").join(worst, "nbr", "left").withColumn("worst", F.coalesce("worst", F.lit(-2.0)))
        rows = near.join(vectors, "nbr").select("id", "nbr", "worst", "grp", "v")

        def compare(batches):
            def local(table):
                ids, worst, of, x = *(table.column(c).to_numpy() for c in (1, 2, 3)), _matrix(table.column(4).combine_chunks())
                sim = x @ x.T
                sim[of[:, None] == of[None, :]] = -3
                a, b = np.nonzero(sim > worst[:, None])
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b]), pa.array(sim[a, b])], schema=EDGES)

            yield from stream_groups(batches, local)

        found = _sorted_by(rows, "id", "nbr").mapInArrow(compare, "id long, nbr long, sim double")
        merged = graph.withColumn("fresh", F.lit(0)).unionByName(found.withColumn("fresh", F.lit(1)))
        graph = materialize(_best(merged, k))
        moved, entries = graph.agg(F.sum("fresh"), F.count(F.lit(1))).head()
        if (moved or 0) <= SETTLED * (entries or 1):
            break
    return graph.select("id", "nbr", "sim")


COUNTS = pa.schema([("cls", pa.int64()), ("links", pa.int64())])


def complete(members: DataFrame, threshold: float) -> DataFrame:
    """``cls, links``: linked rows of each class inside its component.

    ``members``: component, cls, n, v.  Pairs of blocks are the unit of work.
    """
    size = members.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    m = members.join(size, "component").withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    m = m.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    lo, hi = F.least("block", "other"), F.greatest("block", "other")
    m = m.select(F.xxhash64("component", lo, hi).alias("unit"), (F.col("block") == lo).alias("low"), (lo == hi).alias("same"), "cls", "n", "v")

    def count(batches):
        def unit(table):
            ids, n, x = table.column(3).to_numpy(), table.column(4).to_numpy(), _matrix(table.column(5).combine_chunks())
            low = table.column(1).to_numpy()
            if table.column(2)[0].as_py():
                link = x @ x.T >= threshold
                np.fill_diagonal(link, False)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(link @ n)], schema=COUNTS)
            elif low.any() and not low.all():
                link = x[low] @ x[~low].T >= threshold
                yield pa.RecordBatch.from_arrays([pa.array(ids[low]), pa.array(link @ n[~low])], schema=COUNTS)
                yield pa.RecordBatch.from_arrays([pa.array(ids[~low]), pa.array(link.T @ n[low])], schema=COUNTS)

        yield from stream_groups(batches, unit)

    return _sorted_by(m, "unit", "low", "cls").mapInArrow(count, "cls long, links long").groupBy("cls").agg(F.sum("links").alias("links"))


TRUTH = pa.schema([("cls", pa.int64()), ("links", pa.int64()), ("others", pa.int64())])


def _true_links(classes: DataFrame, threshold: float, first: int, last: int) -> list:
    """``cls, links, others``: linked rows and linked classes of the vectors first to last by hash."""
    sample = classes.orderBy(F.xxhash64("cls", F.lit(7)), "cls").limit(last).select("cls", "v").toArrow().slice(first).combine_chunks()
    if not len(sample):
        return []
    ids, q = sample.column(0).to_numpy(), _matrix(sample.column(1).combine_chunks())

    def links(batches):
        total, others = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        for b in batches:
            cls, n = b.column(0).to_numpy(), b.column(1).to_numpy()
            row, at = np.nonzero(_matrix(b.column(2)) @ q.T >= threshold)
            other = cls[row] != ids[at]
            total += np.bincount(at[other], n[row[other]], len(ids)).astype(np.int64)
            others += np.bincount(at[other], minlength=len(ids))
        yield arrow_rows(TRUTH, {"cls": ids, "links": total, "others": others})

    truth = classes.select("cls", "n", "v").mapInArrow(links, "cls long, links long, others long")
    return truth.groupBy("cls").agg(F.sum("links").alias("links"), F.sum("others").alias("others")).where("others > 0").collect()


def audit_set(classes: DataFrame, n: int, threshold: float, queries: int) -> list:
    """The true links of the audited vectors; more vectors until enough have one or two linked classes."""
    truth, first, last = [], 0, queries
    while True:
        truth += _true_links(classes, threshold, first, last)
        if last >= min(n, QUERIES) or sum(r["others"] <= 2 for r in truth) >= ENOUGH:
            return truth
        first, last = last, min(3 * last, QUERIES)


def size_class(others: int) -> int:
    """1 to 2, 3 to 5, 6 to 10 linked vectors, then doubling."""
    return 0 if others <= 2 else 1 if others <= 5 else 2 + max(0, math.ceil(math.log2(others / 10)))


def recall_of(truth: list, counted: DataFrame) -> float:
    """Mean share of a vector's links that the counts have, of the size class of groups where it is lowest."""
    if not truth:
        return 1.0
    want = counted.sparkSession.createDataFrame([tuple(r) for r in truth], "cls long, true long, others long")
    both = F.broadcast(want).join(counted, "cls").select("cls", "links").collect()
    found = {r["cls"]: r["links"] for r in both}
    shares: dict[int, list[float]] = {}
    for r in truth:
        shares.setdefault(size_class(r["others"]), []).append(found.get(r["cls"], 0) / r["links"])
    return min(float(np.mean(x)) for x in shares.values())


def all_pairs(classes: DataFrame, n: int, threshold: float) -> DataFrame:
    """``id, nbr``: links that join all linked classes, from comparing each vector with every other.

    ``CHUNK`` vectors at a time go to all tasks; a task sends one link per
    vector, and those that join vectors of the chunk not yet joined there.
    """
    chunks, edges = -(-n // CHUNK), None
    for i in range(chunks):
        part = classes.where(F.pmod(F.xxhash64("cls", F.lit(11)), F.lit(chunks)) == i).select("cls", "v").toArrow()
        if not len(part):
            continue
        ids, q = part.column(0).to_numpy(), _matrix(part.column(1).combine_chunks())

        def links(batches, ids=ids, q=q):
            label = np.arange(len(ids))
            for b in batches:
                cls, a, z = b.column(0).to_numpy(), [], []
                row, at = np.nonzero(_matrix(b.column(1)) @ q.T >= threshold)
                keep = cls[row] != ids[at]
                row, at = row[keep], at[keep]
                cuts = np.flatnonzero(np.r_[True, np.diff(row) > 0, True]) if len(row) else [0]
                for lo, hi in zip(cuts[:-1], cuts[1:]):
                    hits, me = at[lo:hi], cls[row[lo]]
                    joined, head = np.unique(label[hits], return_index=True)
                    a += [me] * len(joined)
                    z += list(ids[hits[head]])
                    label[np.isin(label, joined[1:])] = joined[0]
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(z, pa.int64())], names=["id", "nbr"])

        found = materialize(classes.select("cls", "v").mapInArrow(links, "id long, nbr long"))
        edges = found if edges is None else edges.unionByName(found)
    return edges


def enlarged(graph: DataFrame, classes: DataFrame, n: int, dim: int, k: int, rounds: int, threshold: float, seed: int) -> DataFrame:
    """Links ``id, nbr`` of a graph whose saturated lists were enlarged until their last entries are below the threshold."""
    is_link = F.col("sim") >= threshold - 1e-12
    near = materialize(graph.where(is_link).select("id", "nbr"))
    while True:
        full = graph.groupBy("id").agg(F.count(F.lit(1)).alias("m"), F.min("sim").alias("last")).where((F.col("m") >= k) & (F.col("last") >= threshold))
        full = materialize(full.select(F.col("id").alias("cls"), F.lit(True).alias("full")))
        if not full.limit(1).count():
            return near
        seed += 1000
        comps = components(near, "id", "nbr").withColumnRenamed("id", "cls")
        labelled = classes.select("cls", "v").join(comps, "cls", "left").join(full, "cls", "left")
        labelled = materialize(labelled.select("cls", "v", F.coalesce("component", "cls").alias("grp"), F.coalesce("full", F.lit(False)).alias("seeks")))
        graph = descend(start_graph(labelled, n, dim, k, seed), labelled, k, rounds)
        further = materialize(graph.where(is_link).select("id", "nbr"))
        if not further.limit(1).count():
            return near
        near = near.unionByName(further)


def _counted(near: DataFrame, classes: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(components ``id, component``; ``cls, links`` inside them) of a graph's links."""
    comps = materialize(components(near, "id", "nbr"))
    members = comps.select(F.col("id").alias("cls"), "component").join(classes, "cls").select("component", "cls", "n", "v")
    return comps, materialize(complete(members, threshold))


def near_duplicate_vectors(vectors: DataFrame, threshold: float = 0.95, k: int = 10, rounds: int = 6, recall: float = 0.98, audit: int = 500, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    classes = materialize(vector_classes(rows))
    n = classes.count()
    first = classes.select("v").head()
    counted = comps = None
    if n > 1:
        graph, truth = None, audit_set(classes, n, threshold, audit)
        alone = classes.withColumns({"grp": F.col("cls"), "seeks": F.lit(True)})
        for attempt in range(RETRIES + 1):
            fresh = start_graph(alone, n, len(first["v"]), k, seed=101 + attempt)
            graph = descend(fresh if graph is None else graph.unionByName(fresh), alone, k, rounds)
            near = enlarged(graph, classes, n, len(first["v"]), k, rounds, threshold, seed=101 + attempt)
            comps, counted = _counted(near, classes, threshold)
            if recall_of(truth, counted) >= recall:
                break
        else:
            comps, counted = _counted(all_pairs(classes, n, threshold), classes, threshold)
    grouped = classes.select("cls", "first_id", "n", "v")
    if counted is not None:
        grouped = grouped.join(counted, "cls", "left").join(comps.withColumnRenamed("id", "cls"), "cls", "left")
    else:
        grouped = grouped.withColumns({"links": F.lit(None).cast("long"), "component": F.lit(None).cast("long")})
    grouped = grouped.withColumn("component", F.coalesce("component", "cls"))
    smallest = grouped.groupBy("component").agg(F.min("first_id").alias("smallest"))
    table = materialize(
        grouped.join(smallest, "component").select("v", "smallest", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    )
    out = rows.join(table, "v", "left")
    component = F.coalesce("smallest", "id")
    return out.select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
