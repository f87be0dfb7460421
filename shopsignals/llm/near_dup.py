"""Near-duplicate documents from bottom-k sketches of one hash function.

1. *Sketch*: a text's set of word shingles is hashed with one function; the
   ``k`` smallest values are kept (all of them for smaller sets).  Texts with
   equal sets share a fingerprint and form one class; only classes go on, so
   copies are never expanded.
2. *Inverted lists*: two sets with Jaccard similarity of 0.8 share at least
   ``OVERLAP`` of their k values but for a chance of about 2e-8 (exactly so for
   sets of at most k).  With the values ordered from rare to common, two such
   sketches also share a value among the first ``size - OVERLAP + 1`` of each.
   Only those are listed: values of passages that many texts quote come last
   and are listed only for texts that consist of little else.
3. *Superlists*: lists with the same first member are one, so the many lists
   that near copies share do not repeat the same comparisons.
4. *Overlaps, filter, verification*: the members of a superlist come together
   in blocks of at most ``BLOCK`` members (by hash) with their whole sets.  Matrix
   products over the bottom ``DEEP`` values of each set count what any two have
   in common: the exact similarity for sets up to that size, an estimate for
   larger ones, of which pairs more than five standard deviations too low are
   left out and the others are compared completely.  A unit of two blocks emits
   only links that join two groups, so rows grow with members, not pairs.
   First every block is compared with itself, then the best linked members of
   the blocks of a superlist with each other; groups are contracted, and only
   members outside the largest group of their superlist are compared with all
   other blocks.  Pairs joined already cannot change the groups.
5. Connected components of the links (``components``) give the groups.

Sets are compared as 64-bit hashes of their shingles: a false or missed link
needs a collision of two different shingles (chance about n / 2**64 a pair).

Defined results: a null text, or one without words, has 0 shingles and is
linked with nothing; fewer words than a shingle make one shingle; rows that
repeat an id are separate rows with the same id; null ids never become a
component id while the group has another; an empty table gives an empty
result.  Other columns are not read.  The stage works by row: of a group it
keeps one row of the smallest id that is not null (ties: smallest text hash;
among rows of equal id and text, the smallest row hash), whatever else that id
names; rows without words stay.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsignals.llm.common import arrow_rows, ascii_lower, materialize, quoted, small_batches, stream_groups, unused, words_in
from shopsignals.llm.components import components

K = 32
OVERLAP = 12
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


def words_of(text: str | None) -> list[str]:
    return words_in(ascii_lower(text)) if text else []


def shingle_set(words: list[str], size: int) -> set[tuple]:
    """Distinct shingles as tuples of words."""
    if not words:
        return set()
    if len(words) < size:
        return {tuple(words)}
    return set(zip(*[words[i:] for i in range(size)]))


class Hasher:
    """Hash values of a text's distinct shingles, sorted; word hashes are cached."""

    def __init__(self, size: int):
        self.size, self.cache = size, {}

    def values(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros(0, np.int64)
        cache = self.cache
        if len(cache) > 400_000:
            cache.clear()
        for w in words:
            if w not in cache:
                cache[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
        width = min(self.size, len(h))
        mixed = np.full(len(h) - width + 1, np.uint64(width))
        for i in range(width):
            part = h[i : len(h) - width + 1 + i] * _MULTIPLIERS[i % len(_MULTIPLIERS)] + np.uint64(i)
            part ^= part >> np.uint64(29)
            mixed = (mixed ^ part) * np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= mixed >> np.uint64(32)
        return np.unique(mixed.view(np.int64))


SKETCH = pa.schema([
    ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("class", pa.int64()), ("mark", pa.string()), ("sketch", pa.list_(pa.int64())),
])


def sketches(docs: DataFrame, size: int, k: int = K) -> DataFrame:
    """One row per document; ``class`` and ``mark`` identify the set (null for an empty one)."""

    def run(batches):
        hasher = Hasher(size)
        for b in batches:
            out = {f.name: [] for f in SKETCH}
            out["doc_id"], out["text_hash"] = b.column(0), b.column(2)
            for text in b.column(1).to_pylist():
                v = hasher.values(words_of(text))
                digest = hashlib.blake2b(v.tobytes(), digest_size=16).digest() if len(v) else None
                out["n_shingles"].append(len(v))
                out["class"].append(int.from_bytes(digest[:8], "little", signed=True) if digest else None)
                out["mark"].append(digest.hex() if digest else None)
                out["sketch"].append(v[:k])
            yield arrow_rows(SKETCH, out)

    return docs.mapInArrow(run, "doc_id long, text_hash long, n_shingles long, class long, mark string, sketch array<long>")


def inverted_lists(classes: DataFrame, k: int, threshold: int) -> DataFrame:
    """``value, class, n``: listed values of each class, values of one class left out."""
    entries = classes.select("class", "n", F.explode("sketch").alias("value"))
    shared = entries.groupBy("value").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    per_class = entries.join(shared, "value").groupBy("class").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("m", "value"))).alias("values"))
    # how many of the first values of the sketch are left after those that no one shares
    kept = F.least("n", F.lit(k))
    need = F.least(F.lit(OVERLAP), F.ceil(F.col("n") * threshold / 100))
    first = F.size("values") - need + 1  # sketch - need + 1 - (sketch - shared)
    assert_k = F.least(first, kept)
    listed = per_class.where(first > 0).select("class", "n", F.explode(F.slice("values", F.lit(1), assert_k.cast("int"))).alias("v"))
    return listed.select(F.col("v.value").alias("value"), "class", "n")


# ---------------------------------------------------------------- comparing inside superlists

#: members of a block, and shingles of a block: what one side of a comparison holds in memory
BLOCK = 512
WEIGHT = 1 << 21
#: bottom values per set that are compared first; sets up to this size are compared completely by it
DEEP = 256
#: values whose columns are multiplied at once
COLUMNS = 4096

LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("hub", pa.bool_())])
LINKS_DDL = "a long, b long, hub boolean"


def set_table(rows: DataFrame, size: int) -> DataFrame:
    """``class, n, values``: all shingle hashes of each ``class, text``, sorted, as little-endian 64-bit integers."""

    def run(batches):
        hasher = Hasher(size)
        for b in batches:
            sets = [hasher.values(words_of(t)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(list(map(len, sets)), pa.int64()), pa.array([v.astype("<i8").tobytes() for v in sets], pa.binary())], names=["class", "n", "values"]
            )

    return rows.mapInArrow(run, "class long, n long, values binary")


def _common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Numbers of values that each of ``left`` has in common with each of ``right``, by matrix products."""
    owner = lambda sets: np.repeat(np.arange(len(sets)), [len(v) for v in sets])
    l_value, r_value = np.concatenate(left), np.concatenate(right)
    both = np.intersect1d(l_value, r_value)
    out = np.zeros((len(left), len(right)), np.float32)
    if not len(both):
        return out
    sides = []
    for values, rows in ((l_value, owner(left)), (r_value, owner(right))):
        at = np.minimum(np.searchsorted(both, values), len(both) - 1)
        hit = both[at] == values
        order = np.argsort(at[hit], kind="stable")
        sides.append((at[hit][order], rows[hit][order]))
    for lo in range(0, len(both), COLUMNS):
        hi = min(lo + COLUMNS, len(both))
        cells = []
        for (at, rows), m in zip(sides, (len(left), len(right))):
            i, k = np.searchsorted(at, [lo, hi])
            cell = np.zeros((m, hi - lo), np.float32)
            cell[rows[i:k], at[i:k] - lo] = 1
            cells.append(cell)
        out += cells[0] @ cells[1].T
    return out


class Joiner:
    """Links between members that join groups not joined yet; ``group`` holds each member's group number."""

    def __init__(self, sets: list[np.ndarray], group: np.ndarray, threshold: int):
        self.sets, self.group, self.threshold = sets, group.copy(), threshold
        self.n = np.array([len(v) for v in sets], np.int64)
        slack = 5 * math.sqrt(threshold * (100 - threshold)) / 100
        self.least = (threshold / 100 - slack / math.sqrt(DEEP)) * DEEP
        self.links: list[tuple[int, int]] = []
        self.degree = np.zeros(len(sets), np.int64)

    def _join(self, i: int, j: int) -> None:
        self.links.append((i, j))
        self.group[self.group == self.group[j]] = self.group[i]

    def _linked(self, i: int, j: int) -> bool:
        x, y = self.sets[i], self.sets[j]
        shared = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * shared >= self.threshold * (len(x) + len(y) - shared)

    def compare(self, left: np.ndarray, right: np.ndarray) -> None:
        """All members ``left`` with all members ``right`` (positions; the same array for a block with itself)."""
        if len(left) * len(right) <= 4:
            for i in left.tolist():
                for j in right.tolist():
                    if i != j and self.group[i] != self.group[j] and self._linked(i, j):
                        self._join(i, j)
            return
        shared = _common_counts([self.sets[i][:DEEP] for i in left], [self.sets[j][:DEEP] for j in right])
        n_l, n_r = self.n[left][:, None], self.n[right][None, :]
        fits = (100 * n_l >= self.threshold * n_r) & (100 * n_r >= self.threshold * n_l)
        complete = np.maximum(n_l, n_r) <= DEEP
        certain = fits & complete & (100 * shared >= self.threshold * (n_l + n_r - shared))
        if left is right:
            np.fill_diagonal(certain, False)
        np.add.at(self.degree, left, certain.sum(axis=1))
        if left is not right:
            np.add.at(self.degree, right, certain.sum(axis=0))
        for r in np.flatnonzero(certain.any(axis=1)):
            others = right[certain[r]]
            while len(others := others[self.group[others] != self.group[left[r]]]):
                self._join(left[r], others[0])
        # larger sets: the sketches only say which pairs can be links
        rows, cols = np.nonzero(fits & ~complete & (shared >= self.least))
        apart = self.group[left[rows]] != self.group[right[cols]]
        for i, j in zip(left[rows[apart]].tolist(), right[cols[apart]].tolist()):
            if self.group[i] != self.group[j] and self._linked(i, j):
                self.degree[[i, j]] += 1
                self._join(i, j)


def _joined(units: DataFrame, threshold: int, with_hubs: bool = False) -> DataFrame:
    """Links ``a, b`` that join groups inside units of ``unit, key, low, group, class, values``.

    Members marked ``low`` are one block, the others another one; a unit of one
    block is compared with itself.  Classes of equal ``group`` are joined
    already.  With ``with_hubs`` each unit also names its member with most links
    (``a`` its key, ``b`` the member, ``hub`` true).
    """

    def run(batches):
        def unit(table):
            key, low = table.column(1)[0].as_py(), table.column(2).to_numpy()
            classes = table.column(4).to_numpy()
            _, group = np.unique(table.column(3).to_numpy(), return_inverse=True)
            if group.max() == 0 and not with_hubs:
                return
            joiner = Joiner([np.frombuffer(v, "<i8") for v in table.column(5).to_pylist()], group, threshold)
            first, second = np.flatnonzero(low), np.flatnonzero(~low)
            if len(first) and len(second):
                joiner.compare(first, second)
            else:
                every = np.arange(len(classes))
                joiner.compare(every, every)
            a, b = (list(x) for x in zip(*joiner.links)) if joiner.links else ([], [])
            a, b, hub = list(classes[a]), list(classes[b]), [False] * len(a)
            if with_hubs:
                a, b, hub = a + [key], b + [classes[int(np.argmax(joiner.degree))]], hub + [True]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(hub, pa.bool_())], schema=LINKS)

        yield from stream_groups(batches, unit)

    rows = units.select("unit", "key", "low", "group", "class", "values")
    return rows.repartition("unit").sortWithinPartitions("unit", "low", "class").mapInArrow(run, LINKS_DDL)


def _blocks(count, weight):
    """Number of blocks for so many members with so many shingles."""
    return F.greatest(F.lit(1), F.ceil(count / BLOCK), F.ceil(weight / WEIGHT)).cast("int")


def _block_of(blocks):
    return F.pmod(F.xxhash64("class", F.lit(3)), blocks).cast("int")


def superlists(lists: DataFrame) -> DataFrame:
    """``key, class``: lists with the same first member as one, each class once.

    Near copies share most of their listed values, and the lists of those values
    have nearly the same members; they become one.
    """
    heads = lists.groupBy("value").agg(F.min("class").alias("key"), F.count(F.lit(1)).alias("m")).where("m > 1").select("value", "key")
    return lists.join(heads, "value").select("key", "class").distinct()


def links(lists: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Links ``a, b`` between classes that join every two classes at the threshold whose sketches meet in a list.

    ``sets``: class, n, values.  Pairs that other links have joined already are
    not compared, and one link joins two groups.
    """
    members = materialize(superlists(lists).join(sets, "class").select("key", "class", "n", "values"))
    size = materialize(members.groupBy("key").agg(_blocks(F.count(F.lit(1)), F.sum("n")).alias("blocks")))
    many = materialize(size.where("blocks > 1"))
    # every block with itself
    own = members.join(size, "key").withColumn("block", _block_of(F.col("blocks")))
    own = own.withColumns({"unit": F.xxhash64("key", "block"), "low": F.lit(True), "group": F.col("class")})
    if not many.limit(1).count():
        return materialize(_joined(own, threshold).select("a", "b").distinct())
    found = materialize(_joined(own, threshold, with_hubs=True))
    done = found.where("NOT hub").select("a", "b")
    # the best linked members of the blocks of a superlist with each other
    hubs = found.where("hub").select(F.col("a").alias("key"), F.col("b").alias("class")).join(many.select("key"), "key")
    hubs = hubs.join(members, ["key", "class"])
    hub_size = hubs.groupBy("key").agg(_blocks(F.count(F.lit(1)), F.sum("n")).alias("blocks"))
    hubs = hubs.join(hub_size, "key").withColumn("block", _block_of(F.col("blocks")))
    hubs = hubs.withColumns({"unit": F.xxhash64("key", "block"), "low": F.lit(True), "group": F.col("class")})
    done = materialize(done.unionByName(_joined(hubs, threshold).select("a", "b")).distinct())
    # what is left: members outside the largest group of their superlist, with each other and with that group
    comps = components(done).withColumnRenamed("id", "class")
    left = members.join(many.select("key"), "key").join(comps, "class", "left").withColumn("group", F.coalesce("component", "class"))
    left = materialize(left.select("key", "class", "n", "values", "group"))
    groups = materialize(left.groupBy("key", "group").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("w")))
    top = groups.groupBy("key").agg(F.max_by("group", F.struct("m", "group")).alias("main"), F.count(F.lit(1)).alias("groups")).where("groups > 1")
    plan = groups.join(top, "key").withColumn("outer", F.col("group") != F.col("main"))
    sums = lambda c, outer: F.sum(F.when(F.col("outer") == outer, F.col(c)).otherwise(0))
    plan = materialize(plan.groupBy("key").agg(
        F.first("main").alias("main"), _blocks(sums("m", True), sums("w", True)).alias("o"), _blocks(sums("m", False), sums("w", False)).alias("g"),
    ))
    rest = left.join(plan, "key").withColumn("outer", F.col("group") != F.col("main"))
    mine = F.when(F.col("outer"), _block_of(F.col("o"))).otherwise(F.col("o") + _block_of(F.col("g")))
    # an outer block meets every block, a block of the main group only the outer ones
    others = F.when(F.col("outer"), F.sequence(F.lit(0), F.col("o") + F.col("g") - 1)).otherwise(F.sequence(F.lit(0), F.col("o") - 1))
    rest = rest.withColumn("mine", mine).withColumn("other", F.explode(others))
    lo, hi = F.least("mine", "other"), F.greatest("mine", "other")
    units = rest.withColumns({"unit": F.xxhash64("key", lo, hi), "low": F.col("mine") == lo})
    return materialize(done.unionByName(_joined(units, threshold).select("a", "b")).distinct())


def _groups(docs: DataFrame, size: int = 5, threshold: int = 80, k: int = K, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(sketches per row, ``mark, component_id, keeper``): the group of each set and the row that it keeps."""
    small_batches(docs.sparkSession, 512)
    own_text = F.col(quoted(text_col))
    slim = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), own_text.alias("text"), F.xxhash64(own_text).alias("text_hash"))
    sk = materialize(sketches(slim, size, k))
    # one row per distinct set: its smallest id and its sketch
    classes = materialize(
        sk.where("mark IS NOT NULL").groupBy("class", "mark").agg(
            F.min("doc_id").alias("first_id"), F.min(F.struct("doc_id", "text_hash")).alias("row"),
            F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("best"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")
        )
    )
    lists = materialize(inverted_lists(classes, k, threshold))
    # the whole sets of the classes that share a listed value, one each; an id alone may name several texts
    wanted = classes.join(lists.select("class").distinct(), "class").select("class", F.col("row.doc_id").alias("row_id"), F.col("row.text_hash").alias("row_hash"))
    same_row = F.col("doc_id").eqNullSafe(F.col("row_id")) & (F.col("text_hash") == F.col("row_hash"))
    sets = materialize(set_table(slim.join(wanted, same_row).select("class", "text").dropDuplicates(["class"]), size))
    comps = components(links(lists, sets, threshold))
    grouped = classes.join(comps.withColumnRenamed("id", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    smallest = grouped.groupBy("component").agg(F.min("first_id").alias("component_id"), F.min("best").alias("keeper"))
    return sk, materialize(grouped.join(smallest, "component").select("mark", "component_id", "keeper"))


def near_duplicates(docs: DataFrame, size: int = 5, threshold: int = 80, k: int = K, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row; ``threshold`` in percent."""
    sk, membership = _groups(docs, size, threshold, k, id_col, text_col)
    out = sk.select("doc_id", "n_shingles", "mark").join(membership.select("mark", "component_id"), "mark", "left")
    own = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))


def without_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The documents with one row of each group of near duplicates, with their columns."""
    sk, membership = _groups(docs, **options)
    is_keeper = F.col("doc_id").eqNullSafe(F.col("keeper.doc_id")) & (F.col("text_hash") == F.col("keeper.text_hash"))
    own_id, own_hash, id_of, hash_of = unused(docs.columns, "row_id", "row_hash", "id", "hash")
    texts = sk.where("mark IS NOT NULL").groupBy("doc_id", "text_hash", "mark").agg(F.count(F.lit(1)).alias("m")).join(membership, "mark")
    texts = materialize(texts.select(F.col("doc_id").alias(id_of), F.col("text_hash").alias(hash_of), "m", is_keeper.alias("keeps")))
    names = [F.col(quoted(c)) for c in docs.columns]
    rows = docs.withColumns({own_id: F.col(quoted(options.get("id_col", "doc_id"))).cast("long"), own_hash: F.xxhash64(F.col(quoted(options.get("text_col", "text"))))})
    same = F.col(own_id).eqNullSafe(F.col(id_of)) & (F.col(own_hash) == F.col(hash_of))
    out = rows.join(texts.where("NOT keeps OR m > 1").select(id_of, hash_of), same, "left_anti").select(names)
    repeated = texts.where("keeps AND m > 1").select(id_of, hash_of)
    if not repeated.limit(1).count():
        return out
    again = rows.join(repeated, same, "left_semi")
    one = again.groupBy(own_id, own_hash).agg(F.min_by(F.struct(*names), F.xxhash64(*names)).alias("row"))
    return out.unionByName(one.select("row.*"))
