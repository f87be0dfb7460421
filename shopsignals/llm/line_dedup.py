"""Line de-duplication with a tree of log templates.

Every line walks a tree of fixed depth: number of tokens, then the first
``depth`` tokens (a token with a digit counts as a variable field, ``<*>``).
Behind them, a leaf holds as many templates as its lines have:

1. The *support* of a token at a position is the number of lines of the leaf
   that hold it there.
2. A line orders its remaining positions by support, highest first.  Its
   *candidates* are its own text with the last 0, 1, 2, ... of these positions
   as variable fields, as long as ``similarity`` of the remaining tokens stay.
   A constant token of a template is held by all its lines, a field's value by
   fewer, so fields come last whatever else the leaf holds.
3. A line's template is the candidate that most lines of the leaf have in
   common (ties: the one with fewest fields).  No share of the leaf is asked
   for, so unrelated lines in the leaf, however many, hide no template.

A template whose lines come from at least two documents is dropped from all of
them but the first (smallest id), so a passage that documents share is kept
once, different templates of a leaf each have their own first document, and a
group of copies does not vanish.  Lines without a word, lines of variable
fields only and lines of fewer than ``min_tokens`` tokens stay.

Plan: the distinct masked lines of each document are written once; from then on
lines travel as hashes.  Counts are plain aggregates (combined before the
shuffle), so a line in a third of all documents is one row per task; tokens are
exploded only for leaves that hold several different lines of several
documents, and candidates only for lines that have enough tokens in common with
others.  Candidates are running XORs of token hashes in the order of support, so
a line gives at most one row per token.  The tables of those leaves and of the
dropped lines are broadcast while their counted bytes prove them small, and
joined by shuffle otherwise.

Defined results: null and empty texts stay as they are and have no lines; a
document with a null id takes no part; rows that repeat an id are one document
when documents are compared (their lines count one by one as support) and are
cleaned alike; a document whose lines all go keeps an empty text; an empty
table gives an empty result; other columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopsignals.llm.common import materialize, quoted, unused

FIELD = "<*>"
DEPTH = 4
SIMILARITY = 0.8
MIN_TOKENS = 1


def masked_lines(text: Column) -> Column:
    """The lines of a text: words separated by single spaces, those with a digit masked."""
    for c in "\t\x0b\x0c\r":
        text = F.replace(text, F.lit(c), F.lit(" "))
    text = F.when(F.contains(text, F.lit("  ")), F.regexp_replace(text, " +", " ")).otherwise(text)
    lines = F.transform(F.split(text, "\n", -1), lambda x: F.trim(x))
    return F.transform(lines, lambda x: F.when(x.rlike("[0-9]"), F.regexp_replace(x, r"[^ ]*[0-9][^ ]*", FIELD)).otherwise(x))


def _tokens(masked: Column) -> Column:
    return (F.length(masked) - F.length(F.replace(masked, F.lit(" "), F.lit(""))) + 1).cast("int")


def _key(masked: Column) -> Column:
    return F.xxhash64(masked)


def _leaf(masked: Column, n: Column, depth: int) -> Column:
    return F.xxhash64(n, F.substring_index(masked, " ", depth))


#: joins with a larger table than this shuffle both sides instead of broadcasting it
BROADCAST_BYTES = 32 << 20


def _small(df: DataFrame, bytes_of: Column) -> DataFrame:
    """A written table, marked for broadcasting if its counted bytes prove that it is small."""
    return F.broadcast(df) if (df.agg(F.sum(bytes_of)).head()[0] or 0) <= BROADCAST_BYTES else df


def document_lines(docs: DataFrame, depth: int = DEPTH, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """``doc_id, masked, n, key, leaf``: the distinct masked lines of each document."""
    lines = F.array_distinct(masked_lines(F.col("text")))
    d = docs.where("doc_id IS NOT NULL").select("doc_id", F.explode(lines).alias("masked"))
    # a constant token is left when fields and spaces are taken out
    d = d.where((F.col("masked") != "") & ~F.col("masked").rlike(r"^<\*>(?: <\*>)*$"))
    d = d.withColumn("n", _tokens(F.col("masked"))).where(F.col("n") >= min_tokens)
    return d.withColumns({"key": _key(F.col("masked")), "leaf": _leaf(F.col("masked"), F.col("n"), depth)})


def templates(lines: DataFrame, distinct: DataFrame, depth: int, similarity: float) -> DataFrame:
    """``leaf, key, family``: the template with fields of the lines that have one."""
    # leaves where generalising can join different lines of different documents
    wide = distinct.groupBy("leaf").agg(F.count(F.lit(1)).alias("keys"), F.min("first").alias("lo"), F.max("last").alias("hi"))
    wide = materialize(wide.where((F.col("keys") > 1) & (F.col("hi") > F.col("lo"))).select("leaf"))
    wanted = lines.where(F.col("n") > depth).join(_small(wide, F.lit(16)), "leaf")
    behind = F.transform(F.slice(F.split("masked", " "), depth + 1, 1 << 30), lambda t: F.xxhash64(t))
    # one row per different line: its tokens, and how many lines it stands for
    one = wanted.groupBy("leaf", "key").agg(F.first("masked").alias("masked"), F.count(F.lit(1)).alias("held"))
    cells = materialize(one.select("leaf", "key", "held", F.posexplode(behind).alias("pos", "token")))
    support = cells.groupBy("leaf", "pos", "token").agg(F.sum("held").alias("support"), F.count(F.lit(1)).alias("keys")).where("keys > 1")
    # positions that other lines of the leaf share; the others are fields of every candidate
    size = cells.groupBy("leaf", "key").agg(F.count(F.lit(1)).alias("r"))
    shared = cells.join(support.select("leaf", "pos", "token", "support"), ["leaf", "pos", "token"])
    shared = materialize(shared.select("leaf", "key", "held", "pos", "support", F.xxhash64("pos", "token").alias("h")))
    enough = shared.groupBy("leaf", "key").agg(F.count(F.lit(1)).alias("m")).join(size, ["leaf", "key"])
    enough = enough.where(F.col("m") >= F.col("r") * similarity - 1e-9).select("leaf", "key", "r")
    by_support = Window.partitionBy("leaf", "key").orderBy(F.desc("support"), "pos")
    ranked = shared.join(enough, ["leaf", "key"]).select(
        "leaf", "key", "held", "r", F.row_number().over(by_support).alias("kept"), F.bit_xor("h").over(by_support.rowsBetween(Window.unboundedPreceding, 0)).alias("x"),
    )
    candidates = ranked.where(F.col("kept") >= F.col("r") * similarity - 1e-9).select("leaf", "key", "held", "kept", F.xxhash64("leaf", "kept", "x").alias("family"))
    candidates = materialize(candidates)
    common = candidates.groupBy("family").agg(F.sum("held").alias("lines"), F.count(F.lit(1)).alias("keys")).where("keys > 1")
    best = candidates.join(common, "family").groupBy("leaf", "key").agg(F.max_by("family", F.struct("lines", "kept")).alias("family"))
    return best


def recurring(docs: DataFrame, depth: int = DEPTH, similarity: float = SIMILARITY, min_tokens: int = MIN_TOKENS) -> tuple[DataFrame, DataFrame]:
    """(lines ``doc_id, key``, templates ``key, keeper``): what recurs, and the document that keeps it."""
    lines = materialize(document_lines(docs.select("doc_id", "text"), depth, min_tokens))
    distinct = materialize(lines.groupBy("leaf", "key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")))
    named = distinct.join(templates(lines, distinct, depth, similarity), ["leaf", "key"], "left")
    named = materialize(named.select("key", "first", "last", F.coalesce("family", "key").alias("family"), F.col("family").isNotNull().alias("generalised")))
    kept = named.groupBy("family", "generalised").agg(F.min("first").alias("keeper"), F.max("last").alias("hi")).where("hi > keeper")
    return lines.select("doc_id", "key"), materialize(named.join(kept.drop("hi"), ["family", "generalised"]).select("key", "keeper"))


def dropped_lines(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, drop``: hashes of the masked lines that a document loses."""
    lines, keepers = recurring(docs, **options)
    lost = lines.join(keepers, "key").where(F.col("doc_id") != F.col("keeper"))
    return materialize(lost.groupBy("doc_id").agg(F.sort_array(F.collect_set("key")).alias("drop")))


def without_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> tuple[DataFrame, str, str]:
    """(documents with the lines of recurring templates taken out, names of two added columns).

    The added columns: number of lines, numbers of the dropped ones (from 0).
    """
    own_id, own_text = F.col(quoted(id_col)), F.col(quoted(text_col))
    drops = dropped_lines(docs.select(own_id.alias("doc_id"), own_text.alias("text")), **options)
    key, drop, every, count, dropped = unused(docs.columns, "id", "drop", "all", "lines", "dropped")
    drops = _small(drops, F.lit(32) + F.size("drop") * 8).select(F.col("doc_id").alias(key), F.col("drop").alias(drop))
    d = docs.join(drops, own_id == F.col(key), "left")
    d = d.withColumn(every, F.split(F.coalesce(own_text, F.lit("")), "\n", -1))
    hashes = lambda text: F.transform(masked_lines(text), lambda x, i: F.struct(_key(x).alias("h"), i.alias("i")))
    lost = F.transform(F.filter(hashes(own_text), lambda z: F.array_contains(drop, z["h"])), lambda z: z["i"])
    d = d.withColumn(dropped, F.when(F.col(drop).isNull(), F.array().cast("array<int>")).otherwise(lost))
    left = F.filter(every, lambda x, i: ~F.array_contains(dropped, i))
    text = F.when(F.size(dropped) == 0, own_text).otherwise(F.array_join(left, "\n"))
    return d.withColumn(text_col, text).withColumn(count, F.size(every).cast("long")).drop(key, drop, every), count, dropped


def line_dedup(docs: DataFrame, **options) -> DataFrame:
    """Per document: number of lines, numbers of the dropped ones (as text), characters and MD5 of what stays."""
    d, count, dropped = without_recurring_lines(docs.select("doc_id", "text"), **options)
    text = F.coalesce(F.col("text"), F.lit(""))
    return d.select(
        "doc_id", F.col(count).alias("n_lines"), F.size(dropped).cast("long").alias("n_dropped"),
        F.array_join(dropped, ",").alias("dropped"), F.length(text).cast("long").alias("n_chars_left"), F.md5(F.encode(text, "utf-8")).alias("text_md5"),
    )


def cleaned_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents with their own columns; ``n_chars`` follows the text where there is one."""
    d, _, dropped = without_recurring_lines(docs, **options)
    if "n_chars" in docs.columns:
        d = d.withColumn("n_chars", F.when(F.size(dropped) == 0, F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return d.select([quoted(c) for c in docs.columns])
