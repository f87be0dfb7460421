"""Training-corpus pipeline: five stages, each written as Parquet and read again.

``STAGES`` lists (name, function); a function takes ``(spark, docs, sf_dir)``
and works on everything its predecessor kept.  All but the last return the
columns of ``documents``.  ``run`` applies them to the table ``documents``.
"""

from __future__ import annotations

from shopsignals.llm import line_dedup, mixing, near_dup, packing, toxicity
from shopsignals.llm.common import documents, labels, materialize


def drop_toxic(spark, docs, sf_dir):
    """Documents that the toxicity classifier rejects go."""
    return toxicity.without_toxic(docs, labels(spark, sf_dir))


def drop_recurring_lines(spark, docs, sf_dir):
    """Lines of templates that recur across documents go, but for their first document."""
    return line_dedup.cleaned_documents(docs)


def drop_near_duplicates(spark, docs, sf_dir):
    """One document of each group of near duplicates stays (five-word shingles, similarity 0.8)."""
    return near_dup.without_near_duplicates(docs, size=5, threshold=80)


def mix_sources(spark, docs, sf_dir):
    """Documents are repeated or left out so that sources come near their target shares."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark, docs, sf_dir):
    """Tokenised documents packed into sequences of 4096 tokens."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_recurring_lines),
    ("near_dedup", drop_near_duplicates),
    ("source_mixing", mix_sources),
    ("packing", pack_sequences),
]

#: training, tokenising and rounding have no SQL form; tests hold each stage against brute force
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
