"""Rule-based document quality: a threshold table compiled into one projection.

``THRESHOLDS`` lists statistic, bound and direction; ``quality_rules`` turns
the table into Column expressions over statistics that built-in array
functions compute from each row's own text.  No shuffle, no user function: a
row needs memory in proportion to its own text only, so a hot source or a
group of copies changes nothing.

Defined results: a null or empty text has no words, counts 0 everywhere and
fails the base rule; a null ``doc_id`` passes through; repeated rows give
repeated results; an empty table gives an empty result.  Only the named id and
text columns are read, so other columns can have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: frequent function words of the four languages of the corpus (a parameter)
STOP_WORDS = (
    "the of and to a in is that for it as was with be by on are this at from",
    "le la les de des du et un une est que qui en pour dans par au avec pas sur",
    "der die das und in den von zu mit ist des im für auf ein eine dem nicht als es",
    "el la los las de del y en un una que es por con para se al su lo como",
)


@dataclass(frozen=True)
class Threshold:
    """A document passes while ``statistic`` is within [low, high]."""

    statistic: str
    low: float | None = None
    high: float | None = None


THRESHOLDS = (
    Threshold("n_words", low=50),
    Threshold("mean_word_chars", low=2.0, high=12.0),
    Threshold("symbol_word_ratio", high=0.10),
    Threshold("stop_word_ratio", low=0.02),
    Threshold("duplicate_line_ratio", high=0.50),
    Threshold("upper_char_ratio", high=0.40),
)


def _kept_chars(text: Column, others: str) -> Column:
    """Characters left when the class ``others`` is taken out."""
    return F.length(F.regexp_replace(text, others, "")).cast("long")


def _words(text: Column) -> Column:
    """Same words as ``common.word_array``: every separator becomes a space, then a plain split."""
    for c in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " ", -1), "")


def _windows(words: Column, n_words: Column, make) -> Column:
    """``make(a, b, c, position)`` for each window of three words."""
    tail = lambda k: F.slice(words, F.lit(k), F.greatest(n_words, F.lit(1)))
    zipped = F.arrays_zip(words.alias("a"), tail(2).alias("b"), tail(3).alias("c"))
    return F.transform(F.slice(zipped, F.lit(1), F.greatest(n_words - 2, F.lit(0))), lambda x, i: make(x["a"], x["b"], x["c"], i))


def _sorted_windows(words: Column, n_words: Column) -> Column:
    make = lambda a, b, c, i: F.struct(F.concat_ws(" ", a, b, c).alias("w"), i.alias("i"))
    return F.sort_array(_windows(words, n_words, make))


def _repeated_window_words(windows: Column) -> Column:
    """Words inside 3-word windows that occur at least twice in the text.

    ``windows`` are sorted with their positions; a window equal to a neighbour
    is repeated.  Its words are counted once however many windows hold them.
    """
    size = F.size(windows)
    neighbours = F.arrays_zip(
        windows.alias("x"),
        F.concat(F.array(F.lit("")), F.slice(windows["w"], F.lit(1), size)).alias("before"),
        F.slice(windows["w"], F.lit(2), size).alias("behind"),
    )
    found = F.filter(neighbours, lambda z: (z["x"]["w"] == z["before"]) | (z["x"]["w"] == z["behind"]))
    # each repeated position adds the words up to the next one, three at most
    return F.aggregate(
        F.sort_array(F.transform(found, lambda z: z["x"]["i"])),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("at")),
        lambda a, i: F.struct((a["n"] + F.least(i - a["at"], F.lit(3))).alias("n"), i.alias("at")),
        lambda a: a["n"],
    )


def text_statistics(docs: DataFrame, text_col: str = "text", stop_words=STOP_WORDS) -> DataFrame:
    """Adds ``n_words word_chars n_symbols n_dup_lines n_repeat_words`` and the ratios of the table.

    The work columns are prefixed ``_q_``; a clash with such a name is an error.
    """
    stops = sorted({w for line in stop_words for w in line.split()})
    text = F.coalesce(F.col(text_col), F.lit(""))
    words, n = F.col("_q_words"), F.col("_q_n")
    d = docs.withColumn("_q_words", _words(text)).withColumn("_q_n", F.size("_q_words"))
    # unequal hashes prove that no window is repeated; only the other texts are sorted
    d = d.withColumn("_q_hashes", _windows(words, n, lambda a, b, c, i: F.xxhash64(a, b, c)))
    repeats = F.size(F.array_distinct("_q_hashes")) < F.size("_q_hashes")
    d = d.withColumn("_q_windows", F.when(repeats, _sorted_windows(words, n)))
    d = d.withColumn("_q_lines", F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    d = d.withColumns(
        {
            "n_words": n.cast("long"),
            "word_chars": F.length(F.array_join("_q_words", "")).cast("long"),
            "n_symbols": _kept_chars(text, r"[^#*$%&|<>]+"),
            "n_dup_lines": (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long"),
            "n_repeat_words": F.when(F.col("_q_windows").isNull(), F.lit(0).cast("long")).otherwise(_repeated_window_words(F.col("_q_windows"))),
            "_q_upper": _kept_chars(text, r"[^\p{Lu}]+"),
            "_q_stops": F.size(F.filter(words, lambda w: w.isin(*stops))),
        }
    )
    per_word = lambda c: F.col(c) / F.greatest(F.col("n_words"), F.lit(1))
    return d.withColumns(
        {
            "mean_word_chars": per_word("word_chars"),
            "symbol_word_ratio": per_word("n_symbols"),
            "stop_word_ratio": per_word("_q_stops"),
            "duplicate_line_ratio": F.col("n_dup_lines") / F.greatest(F.size("_q_lines"), F.lit(1)),
            "upper_char_ratio": F.col("_q_upper") / F.greatest(F.col("word_chars"), F.lit(1)),
        }
    )


def verdict(thresholds=THRESHOLDS) -> Column:
    """The threshold table as one boolean expression (true: passes every rule)."""
    rule = F.lit(True)
    for t in thresholds:
        if t.low is not None:
            rule = rule & (F.col(t.statistic) >= F.lit(t.low))
        if t.high is not None:
            rule = rule & (F.col(t.statistic) <= F.lit(t.high))
    return rule


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", thresholds=THRESHOLDS, stop_words=STOP_WORDS) -> DataFrame:
    """One row per document: statistics, base verdict and the verdict of the table."""
    d = text_statistics(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text", stop_words)
    base_failed = (F.col("n_words") < 50) | (F.lit(100) * F.col("n_repeat_words") > F.lit(50) * F.col("n_words"))
    return d.withColumn("base_failed", base_failed).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & verdict(thresholds)).alias("kept"),
        *[t.statistic for t in thresholds if t.statistic != "n_words"],
    )
