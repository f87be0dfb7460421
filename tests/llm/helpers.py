"""Small document tables with every awkward case."""

import random

DOCS_DDL = "doc_id long, text string, lang string, source string, n_chars long"
VOCAB = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def sentence(rng, n):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


def row(doc_id, text, source="a", lang="en"):
    return (doc_id, text, lang, source, None if text is None else len(text))


def awkward(spark, extra=()):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows."""
    rng = random.Random(11)
    long_text = "\n".join(sentence(rng, 12) for _ in range(1500))
    twin = sentence(rng, 60)
    rows = [
        row(0, None), row(1, ""), row(2, " \t\n\x0b "), (3, None, None, None, None), row(4, "one"), row(5, long_text, None),
        row(6, twin, "b"), row(7, twin, "b"), row(7, twin, "b"), (None, twin, None, "b", None), row(8, "Ärger über ÄPFEL 12³ <|endoftext|> 日本 it's\r\nİstanbul", "c"),
        row(9, sentence(rng, 300), "z"), *extra,
    ]
    return spark.createDataFrame(rows, DOCS_DDL)


def empty(spark, ddl=DOCS_DDL):
    return spark.createDataFrame([], ddl)


def clashing(df):
    """The same rows with more columns whose names an operator might use itself."""
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("x") for c in ("value", "key", "n", "class", "leaf", "size", "score", "piece", "length", "word", "row", "group")})
