"""Shared helpers of the training-data operators."""

from __future__ import annotations

import re
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsignals.session import materialize

__all__ = ["WORD", "WORD_RE", "arrow_rows", "bucket_of", "documents", "materialize", "per_process", "quoted", "small_batches", "stream_groups", "unused", "word_array", "words_in"]

#: a word: a run of anything but space, tab, line feed, vertical tab, form feed, carriage return
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)
#: characters at which ``str.split`` cuts and a word does not end
_ODD = "\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def words_in(text: str) -> list[str]:
    """The words of a text; a plain split where no odd separator occurs."""
    return WORD_RE.findall(text) if any(c in text for c in _ODD) else text.split()


def ascii_lower(text: str) -> str:
    """Lower-case A-Z and nothing else."""
    return text.lower() if text.isascii() else text.encode().lower().decode()


def ascii_lower_column(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_array(text: Column) -> Column:
    """The words of a text; null counts as empty."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"), F.lit(1))


def bucket_of(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null for a null id."""
    return F.crc32(doc_id.cast("string")) % F.lit(modulus)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quoted(column: str) -> str:
    """A column's name as a reference, whatever characters it has."""
    return "`" + column.replace("`", "``") + "`"


def unused(columns: list[str], *names: str) -> list[str]:
    """Work names like ``names`` that no column has (names are compared without case)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        made = f"_{name}"
        while made.lower() in taken:
            made = "_" + made
        taken.add(made.lower())
        out.append(made)
    return out


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Bound the Arrow batches handed to Python: whole texts can be long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def per_process(key, make):
    """A value kept for the life of a Python worker (read-only models, word caches)."""
    kept = sys.__dict__.setdefault("_shopsignals_kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def arrow_rows(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def stream_groups(batches, make):
    """Calls ``make(key, table)`` for each run of equal first columns of sorted batches."""
    held, key = [], None
    for b in batches:
        keys = b.column(0).to_numpy()
        cuts = np.r_[0, np.flatnonzero(np.diff(keys)) + 1, len(keys)] if len(keys) else [0]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            if held and keys[lo] != key:
                yield from make(pa.Table.from_batches(held).combine_chunks())
                held = []
            key = keys[lo]
            held.append(b.slice(lo, hi - lo))
    if held:
        yield from make(pa.Table.from_batches(held).combine_chunks())
